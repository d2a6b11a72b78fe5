"""Toxicity: a noisy-channel decoder restores disguised words, then a linear model scores the restored text.

*Language model.*  Counts of four characters in a row over all texts (26 folded letters, other letters, word boundary);
map tasks count densely, so what is shuffled is bounded by the alphabet.  Probabilities back off to shorter contexts.

*Channel.*  Words of letters only, none of them doubled, stay as they are.  Other words become a lattice: a leetspeak sign may be one of its
letters or nothing, a repeated letter may be one or two, a separator inside a word may be nothing or a boundary; runs of
single characters with separators or any white space between them are one lattice.  Each choice has a cost; Viterbi over the last three
characters finds the cheapest reading under costs and language model.

*Score.*  The words of a text, those read from lattices included, and their beginnings are indicators.  Those that differ
between the classes of a bounded labelled sample are kept; naive Bayes support vectors weigh them; scores are calibrated
out of fold.

Defined cases: a null text is empty; texts without kept words get the score of the bias; a null label or id is no label;
an id with several labels has its smallest; without labels of both classes all scores are equal; repeated rows get equal
results; an empty table gives an empty result; other columns are ignored.  Texts of any length are read in full.
"""

from __future__ import annotations

import hashlib
import pickle
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from siftline.llm import margin
from siftline.llm.common import PIECE, Scratch, mixed, split_remainder, text_batches, whole
from siftline.llm.quality import _STEP, labelled_sample

SAMPLE = 8_000
KEPT = 4_096  # features, those that differ most between the classes
STEMS = (4, 5, 6, 7)  # lengths of word beginnings
THRESHOLD = 0.7
FOLDS, HELD_OUT = 3, 1
LEAST_DOCUMENTS, LEAST_DEVIANCE = 5, 40.0
SHARE = 0.25  # of the fitted weights; the rest is the mean weight, so that a word that others made superfluous still counts
LETTERS, ORDER = 28, 4  # boundary, a to z, any other letter
_SPAN = LETTERS ** (ORDER - 1)

# Which letters a sign can stand for
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "bg", "7": "t", "8": "b", "9": "g",
        "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l"}
SEPARATORS = " .*_-~'"
# costs in nats
AS_LETTER, AS_NOTHING, SHORTENED, HALVED, JOINED, PARTED = 1.0, 3.0, 1.0, 9.0, 0.5, 2.0

_EDGE = ".,;:?\"'()[]{}*#%&<>~^`=/\\_-|+"
_PLAIN_EDGE = "".join(c for c in _EDGE if c not in LEET)
_ADDRESS = re.compile(r"://|^[^@]+@[^@]+\.[a-z]+$|^[\d.,:/-]+$")
_DOUBLE = re.compile(r"([^\W\d_])\1")
_SEPARATED = r"(?:\s+|\s?[.*_~,;:/\\-]{1,2}\s?)"
_ALONE = re.compile(rf"(?:^|\s)[a-z0-9@$!]{_SEPARATED}[a-z0-9@$!]{_SEPARATED}[a-z0-9@$!](?![^\s.*_~,;:/\\!?-])")
_QUOTES = re.compile("[\u2000-\u206f\u3000-\u303f«»¿¡]")
_IS_LETTER = np.zeros(256, dtype=bool)
_IS_LETTER[97:123] = _IS_LETTER[128:] = True
_SPACED = re.compile(rf"(?:(?<=\s)|^)(?:[a-z0-9@$!]{_SEPARATED}){{2,}}[a-z0-9@$!](?![^\s.,;:!?])")


def _folded(c: str) -> str:
    base = unicodedata.normalize("NFKD", c.lower())[:1]
    return base if "a" <= base <= "z" else c


def _code(c: str) -> int:
    base = _folded(c)
    return ord(base) - 96 if "a" <= base <= "z" else 27 if c.isalpha() else 0


_CODES = np.array([_code(chr(i)) for i in range(0x250)] + [27], dtype=np.uint8)


def _groups(texts: list[str], size: int) -> Iterator[str]:
    """The texts as lower-case strings of about ``size`` characters, a boundary after each text; long texts are cut."""
    held, n = [], 0
    for text in texts:
        for at in range(0, max(len(text), 1), size):
            piece = text[at : at + size]
            held.append(piece if at + size < len(text) else piece + "\n")
            n += len(piece)
            if n >= size:
                yield "".join(held).lower()
                held, n = [], 0
    yield "".join(held).lower()


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(LETTERS**ORDER, dtype=np.int64)
    carry = np.zeros(ORDER - 1, dtype=np.uint8)
    for batch in batches:
        for text in _groups(batch.column("_t").to_pylist(), 1 << 18):
            raw = np.frombuffer(text.encode("utf-32-le", "replace"), dtype="<u4")
            codes = np.concatenate([carry, _CODES.take(raw, mode="clip")])
            twice = (codes[1:] | codes[:-1]) == 0
            twice[: ORDER - 2] = False
            codes = codes[np.concatenate([[True], ~twice])]
            if codes.size >= ORDER:
                grams = codes[: 1 - ORDER].astype(np.int64)
                for k in range(1, ORDER):
                    grams *= LETTERS
                    grams += codes[k : codes.size - ORDER + 1 + k]
                total += np.bincount(grams, minlength=total.size)
                carry = codes[1 - ORDER :]
    seen = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())], names=["gram", "n"])


def language_model(docs: DataFrame) -> np.ndarray:
    """Cost of every character after every three others, from all texts; at most LETTERS ** ORDER counts reach the driver."""
    rows = docs.select(whole().alias("_t")).mapInArrow(_counted, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(LETTERS**ORDER)
    counts[rows["gram"].to_numpy(dtype=np.int64)] = rows["n"].to_numpy(dtype=np.float64)
    return costs(counts)


def costs(counts: np.ndarray, weight: float = 4.0) -> np.ndarray:
    chance = np.full(LETTERS, 1 / LETTERS)
    for n in range(1, ORDER + 1):
        grams = counts.reshape(-1, LETTERS**n).sum(axis=0).reshape(-1, LETTERS)
        shorter = np.tile(chance.reshape(-1, LETTERS), (max(1, LETTERS ** (n - 1) // max(1, chance.size // LETTERS)), 1))[: grams.shape[0]]
        chance = ((grams + weight * shorter) / (grams.sum(axis=1, keepdims=True) + weight)).reshape(-1)
    return -np.log(chance).astype(np.float32)


def choices(sign: str, n: int) -> list[tuple[str, float]]:
    """What ``n`` times the same sign can stand for and what that costs; a space is a boundary.  From three on ``n`` does not matter."""
    if sign in LEET:
        made = [("", AS_NOTHING)]
        for letter in LEET[sign]:
            made.append((letter, AS_LETTER + (SHORTENED if n > 1 else 0)))
            if n > 1:
                made.append((letter * 2, AS_LETTER + (SHORTENED if n > 2 else 0)))
        return made
    if sign.isalpha():
        letter = _folded(sign)
        return [(letter, (0.0, 0.0, HALVED)[n] if n < 3 else SHORTENED)] + ([(letter * 2, SHORTENED if n > 2 else 0.0)] if n > 1 else [])
    return [("", JOINED), (" ", PARTED if sign in SEPARATORS else JOINED)]


class Channel:
    """The cheapest readings of lattices: Viterbi whose states are the last three characters, with a back pointer per state.

    What a state can become at a place is worked out once and kept.  Where one state is left, or all states have one ancestor,
    everything before is settled and written, so time and memory follow the length of what is read.
    """

    SETTLE, KEPT = 256, 1 << 18

    def __init__(self, model: np.ndarray):
        self.model = model
        self.bases: dict[str, int] = {}  # by up to three equal signs
        self.choices: list[list[tuple[str, float]]] = [[(" ", 0.0)]]
        self.steps: dict[int, list[tuple[int, float, str]]] = {}

    def base(self, run: str) -> int:
        """The number of a run's kind times the number of states."""
        if len(self.bases) >= 1 << 12:
            self.bases, self.choices, self.steps = {}, self.choices[:1], {}
        self.bases[run] = base = len(self.choices) * _SPAN
        self.choices.append(choices(run[0], len(run)))
        return base

    def step(self, place: int) -> list[tuple[int, float, str]]:
        """From state and kind of place, in one number, to the states that follow, with cost and letters."""
        if len(self.steps) >= self.KEPT:
            self.steps.clear()
        kind, state = divmod(place, _SPAN)
        made = []
        for letters, extra in self.choices[kind]:
            at, total = state, extra
            for c in letters:
                code = _code(c)
                if code or at % LETTERS:
                    total += float(self.model[at * LETTERS + code])
                    at = (at * LETTERS + code) % _SPAN
            made.append((at, total, letters))
        self.steps[place] = made
        return made

    def decode(self, noisy: str) -> str:
        out: list[str] = []
        back: list[dict[int, tuple[int, str]]] = []
        paths = {0: 0.0}
        settle = self.SETTLE
        i, n = 0, len(noisy)
        while i <= n:
            j = i + 1
            if i < n:
                sign = noisy[i]
                while j < n and noisy[j] == sign:
                    j += 1
                run = noisy[i : min(j, i + 3)]
                base = self.bases.get(run)
                if base is None:
                    base = self.base(run)
            else:
                base = 0  # the boundary at the end
            i = j
            if len(paths) == 1:
                (state,) = paths
                if back:
                    self._written(out, back, state, len(back))
                    back, settle = [], self.SETTLE
                found = self.steps.get(base + state) or self.step(base + state)
                if len(found) == 1:
                    out.append(found[0][2])
                    paths = {found[0][0]: 0.0}
                    continue
            elif len(back) >= settle:
                common, at = self._ancestor(back, paths)
                if at:
                    self._written(out, back, common, at)
                    back = back[at:]
                settle = self.SETTLE + 2 * len(back)
            after: dict[int, float] = {}
            origin: dict[int, tuple[int, str]] = {}
            for state, cost in paths.items():
                for following, extra, letters in self.steps.get(base + state) or self.step(base + state):
                    total = cost + extra
                    best = after.get(following)
                    if best is None or total < best:
                        after[following] = total
                        origin[following] = (state, letters)
            paths = after
            back.append(origin)
        self._written(out, back, min(paths, key=lambda state: (paths[state], state)), len(back))
        return "".join(out).strip()

    @staticmethod
    def _written(out: list[str], back: list[dict[int, tuple[int, str]]], state: int, upto: int) -> None:
        """Adds the letters of the first ``upto`` places on the way to ``state``."""
        letters = []
        for k in range(upto - 1, -1, -1):
            state, own = back[k][state]
            letters.append(own)
        out.extend(reversed(letters))

    @staticmethod
    def _ancestor(back: list[dict[int, tuple[int, str]]], paths: dict[int, float]) -> tuple[int, int]:
        """The last state that all paths have in common, and how many places lie before it."""
        states = set(paths)
        for k in range(len(back) - 1, -1, -1):
            states = {back[k][s][0] for s in states}
            if len(states) == 1:
                return states.pop(), k
        return 0, 0


def decode(noisy: str, model: np.ndarray) -> str:
    return Channel(model).decode(noisy)


class Restorer:
    """Words of a text with disguised words read through the channel; readings of words are kept, within a bound."""

    KEPT, LONGEST = 1 << 18, 64

    def __init__(self, model: np.ndarray):
        self.read = Channel(model).decode
        self.known: dict[str, str] = {}

    def reading(self, token: str) -> str:
        """The readings of a run without white space that is no plain word."""
        found = " ".join([self.read(core) for core in _cores(token)])
        if len(token) <= self.LONGEST:
            if len(self.known) >= self.KEPT:
                self.known.clear()
            self.known[token] = found
        return found

    def restored(self, text: str) -> str:
        """The text in lower case, followed by the readings of its disguised words."""
        text = text.lower()
        readings, known = [], self.known
        for token in dict.fromkeys(text.split()):
            found = known.get(token)
            if found is None:
                if token.isalpha() and not _DOUBLE.search(token):
                    continue
                found = self.reading(token)
            if found:
                readings.append(found)
        if _ALONE.search(text):
            readings += [self.read(re.sub(r"[\s,;:/\\]+", " ", m[0])) for m in _SPACED.finditer(text) if any(c.isalpha() for c in m[0])]
        if not text.isascii():
            text = _QUOTES.sub(" ", text)
        return " ".join([text, *readings])


_RESTORERS: dict[str, Restorer] = {}


def restorer_for(name: str, model: np.ndarray) -> Restorer:
    """The restorer of a worker: it outlives tasks, so that words are read once a worker and not once a task."""
    if name not in _RESTORERS:
        _RESTORERS.clear()
        _RESTORERS[name] = Restorer(model)
    return _RESTORERS[name]


def name_of(model: np.ndarray) -> str:
    return hashlib.sha256(model.tobytes()).hexdigest()


def _without_runs(token: str) -> str:
    """``token`` without three or more equal signs at its start or end."""
    for strip, at in ((str.lstrip, 0), (str.rstrip, -1)):
        if token and not (token[at].isalnum() or token[at] == "_" or token[at].isspace()):
            left = strip(token, token[at])
            token = left if len(token) - len(left) >= 3 else token
    return token


def _cores(token: str) -> list[str]:
    """What is read of a run without white space: without the punctuation at its edges, and also with edge signs that can be letters."""
    narrow = _without_runs(token.lstrip(_EDGE).rstrip(_EDGE + "!")).strip(_EDGE).rstrip("!")
    wide = token.strip(_PLAIN_EDGE)
    made = [narrow] if wide.rstrip("!") == narrow else [narrow, wide]
    return [core for core in made if len(core) >= 3 and not (core.isalpha() and not _DOUBLE.search(core)) and not _ADDRESS.search(core) and any(c.isalpha() for c in core)]


def _word_hashes(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every run of letters the start, the hash, and the hashes of its beginnings (0 where it is no longer than that)."""
    at = np.flatnonzero(_IS_LETTER[raw])
    if at.size == 0:
        return at, np.empty(0, np.uint64), np.empty((len(STEMS), 0), np.uint64)
    starts = np.flatnonzero(np.diff(at) > 1) + 1
    heads = np.concatenate([[0], starts])
    sizes = np.concatenate([starts, [at.size]]) - heads
    within = at - np.repeat(at[heads], sizes)
    share = (raw[at] + np.uint64(1)) * _STEP[within & 511]
    stems = [np.where(sizes > k, mixed(np.add.reduceat(share * (within < k), heads) + np.uint64(k)), np.uint64(0)) for k in STEMS]
    return at[heads], mixed(np.add.reduceat(share, heads)), np.stack(stems)


def features(texts: list[str]) -> list[np.ndarray]:
    """Per text the hashes of its words, and of word beginnings with the number of distinct words (1, 2, 3, 5) that begin
    so: families of words that share a stem are seen even where each single word is rare."""
    out: list[np.ndarray] = []
    group: list[bytes] = []
    for i, text in enumerate(texts):
        group.append(text.encode("utf-8", "replace"))
        if i + 1 == len(texts) or sum(map(len, group)) > PIECE:
            starts, words, stems = _word_hashes(np.frombuffer(b"\n".join(group), dtype=np.uint8))
            cuts = np.searchsorted(starts, np.cumsum([len(t) + 1 for t in group]))
            for low, high in zip(np.append(0, cuts[:-1]), cuts, strict=True):
                own, first = np.unique(words[low:high], return_index=True)
                begun, n = np.unique(stems[:, low:high][:, first].ravel(), return_counts=True)
                begun, n = (begun[1:], n[1:]) if begun.size and begun[0] == 0 else (begun, n)
                levels = [begun[n >= least] + np.uint64(least) for least in (1, 2, 3, 5)]
                out.append(np.sort(mixed(np.concatenate([own, *levels])).view(np.int64)))
            group = []
    return out


def _small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            yield batch.slice(at, 256)


def _kept_only(kept: np.ndarray):
    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [np.frombuffer(i, np.int64) for i in batch.column("i").to_pylist()]
            rows = [np.flatnonzero(np.isin(kept, r, assume_unique=True)).astype(np.int64).tobytes() for r in rows]
            yield pa.RecordBatch.from_arrays([batch.column("_o"), batch.column("_y"), pa.array(rows, pa.binary())], names=["_o", "_y", "i"])

    return select


def _fitted(table: pa.Table) -> pa.Table:
    """The model of the sample, made in one task; the sample is bounded and only kept features are left."""
    table = table.sort_by("_o")
    rows = [np.frombuffer(i, np.int64) for i in table.column("i").to_pylist()]
    labels = np.array(table.column("_y").to_pylist(), dtype=np.float64)
    return pa.table({"model": pa.array([pickle.dumps(margin.fit([(r, np.ones(r.size)) for r in rows], labels, KEPT, share=SHARE))], pa.binary())})


def train(docs: DataFrame, labels: DataFrame, model: np.ndarray, sample: int = SAMPLE):
    """Kept feature hashes and the linear model."""
    shared, name = docs.sparkSession.sparkContext.broadcast(model), name_of(model)
    chosen = labelled_sample(labels, "toxic", FOLDS, HELD_OUT, sample)
    texts = docs.select(F.col("doc_id").cast("long").alias("_id"), whole().alias("_t")).join(F.broadcast(chosen), "_id")
    texts = texts.groupBy("_id", "_o", "_y").agg(F.min("_t").alias("_t"))

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = restorer_for(name, shared.value)
        for batch in _small(batches):
            rows = features([restorer.restored(t) for t in batch.column("_t").to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column("_o"), batch.column("_y"), pa.array([r.tobytes() for r in rows], pa.binary()),
                                              pa.array(rows, pa.list_(pa.int64()))], names=["_o", "_y", "i", "f"])

    scratch = Scratch(docs.sparkSession)
    rows = scratch.keep(texts.select("_o", "_y", "_t").mapInArrow(featured, "_o long, _y int, i binary, f array<long>"), "sample")
    n, positives = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("_y"), F.lit(0))).first()
    if n == 0:
        return np.empty(0, np.int64), margin.fit([], np.empty(0), 1)
    # chi-square of a feature against the classes
    share = positives / n
    expected, spread = F.col("n") * share, F.col("n") * (1 - F.col("n") / F.lit(n)) * (share * (1 - share))
    counted = rows.select("_y", F.explode("f").alias("f")).groupBy("f").agg(F.count(F.lit(1)).alias("n"), F.sum("_y").alias("p")).filter(F.col("n") >= LEAST_DOCUMENTS)
    scored_ = counted.withColumn("x", F.pow(F.col("p") - expected, 2) / F.greatest(spread, F.lit(1e-9))).filter(F.col("x") >= LEAST_DEVIANCE)
    kept = np.array(sorted(r["f"] for r in scored_.orderBy(F.desc("x"), "f").limit(KEPT).select("f").collect()), dtype=np.int64)
    small = rows.select("_o", "_y", "i").mapInArrow(_kept_only(kept), "_o long, _y int, i binary")
    made = small.groupBy(F.lit(1).alias("_k")).applyInArrow(_fitted, "model binary").collect()
    scratch.drop("sample")
    return kept, pickle.loads(made[0]["model"])


def scored(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted."""
    text_batches(docs.sparkSession)
    model = language_model(docs)
    kept, linear = train(docs, labels, model)
    shared, name = docs.sparkSession.sparkContext.broadcast((model, kept, linear)), name_of(model)

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        costs_, known, fitted = shared.value
        restorer = restorer_for(name, costs_)
        for batch in _small(batches):
            rows = []
            for own in features([restorer.restored(t) for t in batch.column("_t").to_pylist()]):
                at = np.searchsorted(known, own)
                at = at[(at < known.size) & (known[np.minimum(at, known.size - 1)] == own)] if known.size else at[:0]
                rows.append((at, np.ones(at.size)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fitted.score(rows), pa.float64())], names=["doc_id", "score"])

    packed = docs.select("doc_id", whole().alias("_t"))
    rows = packed.mapInArrow(scores, StructType([packed.schema["doc_id"], StructField("score", DoubleType())]))
    return rows.select("doc_id", (split_remainder(FOLDS) == HELD_OUT).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
