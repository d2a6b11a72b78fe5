"""Dictionary phrases as one compact regular expression.

All phrases of a dictionary share one prefix tree, so a position in the text is compared with the
branches of the tree and not with every phrase.
"""

from __future__ import annotations

import re

from siftline.functions.text import WORD

_SPECIAL = re.compile(r"([\\^$.|?*+()\[\]{}\-&#~])")
NOTHING = "(?!)"
_WORDISH = re.compile(r"\w", re.UNICODE)


def _escape(text: str) -> str:
    return _SPECIAL.sub(r"\\\1", text)


def _tree(phrases: list[str]) -> dict:
    root: dict = {}
    for phrase in phrases:
        node = root
        for char in phrase:
            node = node.setdefault(char, {})
        node[""] = {}
    return root


def _branches(node: dict) -> str:
    options = []
    for char in sorted(k for k in node if k):
        run, child = char, node[char]
        while len(child) == 1 and "" not in child:  # a run without a fork is one literal
            char = next(iter(child))
            run, child = run + char, child[char]
        options.append(_escape(run) + ("" if set(child) == {""} else _branches(child)))
    if "" in node:
        options.append("")  # longer phrases first, the phrase that ends here last
    return options[0] if len(options) == 1 else "(?:" + "|".join(options) + ")"


def phrase_pattern(phrases: list[str]) -> str:
    """Pattern that finds any of the phrases as whole words."""
    if not phrases:
        return NOTHING
    return f"(?<!{WORD}){_branches(_tree(phrases))}(?!{WORD})"


def longest_phrase_pattern(phrases: list[str]) -> str:
    """Zero-width pattern whose group 1 is the longest phrase that starts at a position."""
    if not phrases:
        return f"({NOTHING})"
    return f"(?<!{WORD})(?=({_branches(_tree(phrases))})(?!{WORD}))"


def implied(phrases: list[str]) -> dict[str, list[str]]:
    """For each phrase the dictionary phrases that must also match where it matches: itself and its
    prefixes that end at a word boundary."""
    known = set(phrases)
    out = {}
    for phrase in known:
        out[phrase] = [phrase[:n] for n in range(1, len(phrase) + 1)
                       if phrase[:n] in known and (n == len(phrase) or not _WORDISH.match(phrase[n]))]
    return out
