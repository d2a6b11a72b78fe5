"""A small rules bundle in the style of the real ones, with sentences of our own."""

from siftline.rules import load_rules

KEYWORDS = {
    "products": {
        "MOTOR": ["car insurance", "vehicle insurance"], "HOME": ["home insurance"], "CONTENTS": ["contents insurance"], "OTHER": ["pet insurance"]},
    "signals": {
        "quote": ["need a quote", "quote for", "need car insurance"], "recommendation": ["recommend"], "switch": ["changing insurer"],
        "premium": ["premium increased", "too expensive"], "south_africa": ["johannesburg", "cape town", "durban", "pretoria"],
        "broker": ["insurance broker", "broker"], "seller": ["i'm a broker", "sign up with me"], "job": ["hiring"], "news": ["press release"],
        "broker_request": ["looking for a broker"], "solicitation": ["dm me"]},
    "relevance_terms": ["insurance", "premium"],
}


def book(**scoring):
    return load_rules(KEYWORDS, scoring)
