"""SentencePiece encoding and decoding by a max-plus scan.

The pieces and scores of a model file span a lattice over a text; the encoding is the path with the largest sum, and at
every place where two paths tie the one whose last piece starts first, as in the unigram encoder of the library.  Sums
are whole numbers and exact.  Model files of the merging kind bring ranks as scores; they are read as they stand.

A short text is encoded at once: no piece crosses from a letter to a space, so the path falls into independent stretches.  A long text is cut into chunks of ``CHUNK`` characters and no task sees more than one of them at a time:

1. per chunk a transfer matrix: entry (s, t) is the best sum from s characters behind its start to t behind its end, for
   the places where a piece that crosses the border can end;
2. matrices are multiplied in (max, +), ``FAN`` neighbours at a time, up a tree; going down, every chunk gets the best
   sums of its border places from the start of the text;
3. from these every chunk knows for each way out which way in the best path takes; these maps are composed up and down a
   tree in the same way, from the end of the text;
4. every chunk is traced back on its own.

Text is taken as it stands (no normalisation); a space in front is added and taken away again; characters without a piece
become bytes, and so does the mark that stands for a space inside pieces, so every text is restored exactly.

Defined cases: a null or empty text has one part without ids; equal long texts share their matrices; repeated rows give
equal rows; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from siftline.llm.common import Scratch, text_batches, whole

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
CHUNK = 1 << 15
FAN = 16
REMEMBERED = 200_000
STRETCH = 400  # characters; sums of so many scores above FLOOR are whole numbers in single precision
MARK = "▁"
OWN_MARK = "\ud800"  # the mark as an ordinary character; no valid text holds it
NEVER = -(1 << 61)
FLOOR = -40_000.0  # runs of spaces have a score of minus one thousand million in the file, which hides all others
_STRETCH = re.compile(rf"[\s\S]{{1,{STRETCH}}}(?:\Z|(?<!{MARK})(?={MARK}))|{MARK}*[^{MARK}]+|{MARK}+")
NORMAL, UNKNOWN, CONTROL, USER, BYTE = 1, 2, 3, 4, 6


class Lexicon:
    """Pieces of a model file; plain data, so that it can be sent to the tasks."""

    def __init__(self, pieces: list[tuple[str, float, int]], library: bytes = b""):
        scores = {p: s for p, s, kind in pieces if kind in (NORMAL, USER)}
        if any(s != int(s) for s in scores.values()):  # keep fractions exact enough and sums whole
            scores = {p: round(s * (1 << 20)) for p, s in scores.items()}
        self.scores = {p: int(s) for p, s in scores.items()}
        self.ids = {p: i for i, (p, _, kind) in enumerate(pieces) if kind in (NORMAL, USER)}
        self.bytes = {int(p[3:5], 16): i for i, (p, _, kind) in enumerate(pieces) if kind == BYTE}
        self.unknown = min(self.scores.values()) - 10
        self.longest = max(map(len, self.scores))
        self.texts = {i: p for p, i in self.ids.items()}
        self.values = {i: b for b, i in self.bytes.items()}
        if any(MARK in p.lstrip(MARK) for p in self.scores) or len(self.bytes) != 256:
            raise ValueError("pieces with a space behind a letter, or without bytes, are not supported")
        alone = "".join(c for c in "\n\t\r" if not any(c in p for p in self.scores))
        self.unit = re.compile(f"[{alone}]|{MARK}+[^{MARK}{alone}]*|[^{MARK}{alone}]+" if alone else f"{MARK}+[^{MARK}]*|[^{MARK}]+")
        self.library = library
        self.letters = {p for p in self.scores if len(p) == 1}
        self.begins = {p[:k] for p in self.scores for k in range(1, len(p) + 1)}
        # what an id decodes to on its own; None for a byte that is part of a longer character
        self.alone = [None] * len(pieces)
        for p, i in self.ids.items():
            self.alone[i] = p.replace(MARK, " ")
        for b, i in self.bytes.items():
            self.alone[i] = chr(b) if b < 0x80 else None

    @classmethod
    def load(cls, path: str) -> Lexicon:
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto()
        with open(path, "rb") as file:
            proto.ParseFromString(file.read())
        spec = proto.normalizer_spec
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.add_dummy_prefix:
            raise ValueError("only models without normalisation and with a leading space are supported")
        for piece in proto.pieces:
            piece.score = max(piece.score, FLOOR)
        proto.trainer_spec.model_type = pb.TrainerSpec.UNIGRAM
        spec.add_dummy_prefix = False
        return cls([(p.piece, p.score, p.type) for p in proto.pieces], proto.SerializeToString())

    def symbols(self, text: str, first: bool) -> str:
        own = text.replace(MARK, OWN_MARK).replace(" ", MARK)
        return MARK + own if first and text else own

    def edges(self, symbols: str, start: int, stop: int) -> Iterator[tuple[int, int]]:
        """Ends and scores of the pieces that begin at ``start``."""
        single = False
        for end in range(start + 1, min(start + self.longest, stop) + 1):
            score = self.scores.get(symbols[start:end])
            if score is not None:
                single |= end == start + 1
                yield end, score
        if not single:
            yield start + 1, self.unknown

    def write(self, piece: str) -> list[int]:
        number = self.ids.get(piece)
        if number is not None:
            return [number]
        return [self.bytes[b] for b in piece.replace(OWN_MARK, MARK).encode("utf-8")]

    def sums(self, symbols: str, low: int, high: int, stop: int, given: dict[int, int]) -> tuple[dict[int, int], dict[int, int]]:
        """Best sums and last starts of places from ``low`` on, over pieces that start before ``high`` and end by ``stop``.

        ``given`` has sums of places reached from outside; they win ties, since their pieces start earlier.
        """
        best, back = dict(given), {}
        for start in range(low, high):
            own = best.get(start, NEVER)
            if own == NEVER:
                continue
            for end, score in self.edges(symbols, start, stop):
                if own + score > best.get(end, NEVER):
                    best[end], back[end] = own + score, start
        return best, back

    def traced(self, symbols: str, back: dict[int, int], end: int) -> tuple[list[int], int]:
        """Ids on the way back from ``end`` and the place where the way ends."""
        parts = []
        while end in back:
            start = back[end]
            parts.append(self.write(symbols[start:end]))
            end = start
        return list(chain.from_iterable(reversed(parts))), end

    def best(self, unit: str) -> tuple[int, list[int]]:
        """Sum and ids of the best path over a short text."""
        size = len(unit)
        sums, back = [NEVER] * (size + 1), [0] * (size + 1)
        sums[0] = 0
        scores, begins = self.scores, self.begins
        for start in range(size):
            own, single = sums[start], False
            for end in range(start + 1, size + 1):
                piece = unit[start:end]
                if piece not in begins:
                    break
                if piece in scores:
                    total = own + scores[piece]
                    if total > sums[end]:
                        sums[end], back[end] = total, start
                    if end == start + 1:
                        single = True
            if not single and own + self.unknown > sums[start + 1]:
                sums[start + 1], back[start + 1] = own + self.unknown, start
        ids: list[int] = []
        end = size
        while end:
            start = back[end]
            ids[:0] = self.write(unit[start:end])
            end = start
        return sums[size], ids

    def decode(self, ids: list[int], first: bool = True) -> str:
        """The text of ids; of the first part of a text the leading space goes."""
        texts = list(map(self.alone.__getitem__, ids))
        if None in texts:
            out = bytearray()
            for i, text in zip(ids, texts, strict=True):
                out += bytes([self.values[i]]) if text is None else text.encode("utf-8")
            whole_text = out.decode("utf-8")
        else:
            whole_text = "".join(texts)
        return whole_text[1:] if first and len(ids) else whole_text


class Encoder:
    """A lexicon at work: texts fall into stretches between borders that no piece crosses."""

    def __init__(self, lexicon: Lexicon):
        import sentencepiece

        self.lexicon = lexicon
        self.library = sentencepiece.SentencePieceProcessor(model_proto=lexicon.library) if lexicon.library else None
        self.sums: dict[str, int] = {}

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of texts in symbols.  Short stretches go through the library's lattice over the same pieces and scores,
        whose sums are exact at this length; the few others go through the lattice here."""
        stretches = [_STRETCH.findall(t) for t in texts]
        flat = list(chain.from_iterable(stretches))
        plain = [self.library is not None and len(x) <= STRETCH and OWN_MARK not in x for x in flat]
        quick = iter(self.library.encode([x for x, p in zip(flat, plain, strict=True) if p], num_threads=1) if any(plain) else [])
        made = iter([next(quick) if p else self.lexicon.best(x)[1] for x, p in zip(flat, plain, strict=True)])
        return [np.fromiter(chain.from_iterable(next(made) for _ in own), dtype=np.int32) for own in stretches]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return self.ids([self.lexicon.symbols(t, True) for t in texts])

    def units(self, symbols: str) -> list[str]:
        return self.lexicon.unit.findall(symbols)

    def total(self, units: list[str]) -> int:
        """Sum of the scores of encoded units."""
        total = 0
        for unit in units:
            if unit not in self.sums:
                if len(self.sums) > REMEMBERED:
                    self.sums.clear()
                self.sums[unit] = self.lexicon.best(unit)[0]
            total += self.sums[unit]
        return total


_ENCODERS: dict[str, Encoder] = {}


def encoder_for(path: str, lexicon: Lexicon) -> Encoder:
    """The encoder of a worker, kept from task to task."""
    if path not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[path] = Encoder(lexicon)
    return _ENCODERS[path]


class Chunk:
    """One chunk of a long text with the characters behind it that a crossing piece can take."""

    def __init__(self, encoder: Encoder, text: str, ahead: str, first: bool):
        self.encoder, lexicon = encoder, encoder.lexicon
        own = lexicon.symbols(text, first)
        self.size, self.symbols = len(own), own + lexicon.symbols(ahead, False)
        self.reach = min(lexicon.longest - 1, len(self.symbols) - self.size)  # furthest way out
        units = encoder.units(own)
        ends = np.cumsum([len(u) for u in units])
        # a border of units is passed by every path: what lies between two of them is the same for all ways in and out
        low = int(np.searchsorted(ends, lexicon.longest - 1))
        self.middle = units[low + 1 : -1]
        if self.middle:
            self.low, self.high = int(ends[low]), int(ends[-2])
        else:
            self.low = self.high = 0

    def matrix(self) -> np.ndarray:
        lexicon, width = self.encoder.lexicon, self.encoder.lexicon.longest
        out = np.full((width, width), NEVER, dtype=np.int64)
        places = range(self.size, self.size + self.reach + 1)
        if self.middle:
            between = self.encoder.total(self.middle)
            tail, _ = lexicon.sums(self.symbols, self.high, self.size, self.size + self.reach, {self.high: 0})
        for s in range(width):
            if self.middle:
                head, _ = lexicon.sums(self.symbols, s, self.low, self.low, {s: 0})
                base = head.get(self.low, NEVER)
                row = [NEVER if base == NEVER or tail.get(p, NEVER) == NEVER else base + between + tail[p] for p in places]
            else:
                best, _ = lexicon.sums(self.symbols, s, self.size, self.size + self.reach, {s: 0})
                row = [best.get(p, NEVER) for p in places]
            out[s, : len(row)] = row
        return out

    def _ways(self, sums: np.ndarray):
        lexicon = self.encoder.lexicon
        given = {s: int(v) for s, v in enumerate(sums) if v > NEVER // 2}
        if self.middle:
            head = lexicon.sums(self.symbols, 0, self.low, self.low, given)[1]
            return head, lexicon.sums(self.symbols, self.high, self.size, self.size + self.reach, {self.high: 0})[1]
        return None, lexicon.sums(self.symbols, 0, self.size, self.size + self.reach, given)[1]

    def ways_in(self, sums: np.ndarray) -> np.ndarray:
        """For every way out the way in."""
        lexicon = self.encoder.lexicon
        head, tail = self._ways(sums)
        out = np.zeros(lexicon.longest, dtype=np.uint8)
        if head is not None:
            out[:] = lexicon.traced(self.symbols, head, self.low)[1]
        else:
            for t in range(self.reach + 1):
                end = lexicon.traced(self.symbols, tail, self.size + t)[1] if self.size + t in tail else 0
                out[t] = end
        return out

    def trace(self, sums: np.ndarray, way_out: int) -> np.ndarray:
        lexicon = self.encoder.lexicon
        head, tail = self._ways(sums)
        ids, _ = lexicon.traced(self.symbols, tail, self.size + way_out)
        if head is None:
            return np.array(ids, dtype=np.int32)
        middle = self.encoder.ids([self.symbols[self.low : self.high]])[0]
        return np.concatenate([np.array(lexicon.traced(self.symbols, head, self.low)[0], dtype=np.int32), middle, np.array(ids, dtype=np.int32)])


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Matrix product in (max, +)."""
    return np.maximum((a[:, :, None] + b[None, :, :]).max(axis=1), NEVER)


_NODE = "tkey string, node long"


def _up(level: DataFrame, merge, scratch: Scratch, name: str) -> DataFrame:
    """One level of the tree: ``FAN`` neighbouring nodes become one."""
    def merged(keys: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"tkey": [keys[0]], "node": [keys[1]], "m": [merge(rows.sort_values("node")["m"].tolist())]})

    return scratch.keep(level.groupBy("tkey", F.floor(F.col("node") / FAN).alias("up")).applyInPandas(merged, _NODE + ", m binary"), name)


def _down(level: DataFrame, above: DataFrame, spread, scratch: Scratch, name: str) -> DataFrame:
    """Hands the value ``v`` of a node to its children."""
    parents = above.select(F.col("tkey").alias("_k"), F.col("node").alias("_n"), "v")
    joined = level.join(parents, (F.col("tkey") == F.col("_k")) & (F.floor(F.col("node") / FAN) == F.col("_n"))).select("tkey", "node", "m", "v")

    def handed(keys: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("node")
        return pd.DataFrame({"tkey": rows["tkey"], "node": rows["node"], "v": spread(rows["m"].tolist(), rows["v"].iloc[0])})

    return scratch.keep(joined.groupBy("tkey", F.floor(F.col("node") / FAN)).applyInPandas(handed, _NODE + ", v binary"), name)


def _scan(leaves: DataFrame, levels: int, merge, spread, root: bytes, scratch: Scratch, name: str) -> DataFrame:
    """Up the tree with ``merge``, then down with ``spread``: a value for every leaf."""
    tree = [leaves]
    for i in range(levels):
        tree.append(_up(tree[-1], merge, scratch, f"{name}-up{i}"))
    values = tree[-1].select("tkey", "node", F.lit(root).alias("v"))
    for i in range(levels - 1, -1, -1):
        values = _down(tree[i], values, spread, scratch, f"{name}-down{i}")
    scratch.drop(*[f"{name}-up{i}" for i in range(levels)], *[f"{name}-down{i}" for i in range(1, levels)])
    return values


def _width(raw: bytes) -> int:
    return int((len(raw) // 8) ** 0.5)


def _merge_sums(parts: list[bytes]) -> bytes:
    out = None
    for raw in parts:
        own = np.frombuffer(raw, np.int64).reshape(_width(raw), -1)
        out = own if out is None else product(out, own)
    return out.tobytes()


def _spread_sums(parts: list[bytes], value: bytes) -> list[bytes]:
    """Best sums at the ways into each child."""
    width, out = _width(parts[0]), []
    sums = np.full(width, NEVER, dtype=np.int64)
    sums[: len(value) // 8] = np.frombuffer(value, np.int64)
    for raw in parts:
        out.append(sums.tobytes())
        sums = product(sums[None, :], np.frombuffer(raw, np.int64).reshape(width, -1))[0]
    return out


def _merge_ways(parts: list[bytes]) -> bytes:
    """Way out of the last child to way into the first."""
    out = np.frombuffer(parts[-1], np.uint8)
    for raw in reversed(parts[:-1]):
        out = np.frombuffer(raw, np.uint8)[out]
    return out.tobytes()


def _spread_ways(parts: list[bytes], value: bytes) -> list[bytes]:
    """Way out of each child, given that of the last."""
    out, way = [], value[0]
    for raw in reversed(parts):
        out.append(bytes([way]))
        way = raw[way]
    return out[::-1]


_PIECE = "doc_id long, tkey string, part long, parts long, text string, ahead string"


def _cut(longest: int, chunk: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, (key, text) in enumerate(zip(batch.column("tkey").to_pylist(), batch.column("_t").to_pylist(), strict=True)):
                parts = len(text) // chunk
                for part in range(parts):
                    end = len(text) if part + 1 == parts else (part + 1) * chunk
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("doc_id").slice(i, 1), pa.array([key]), pa.array([part], pa.int64()), pa.array([parts], pa.int64()),
                         pa.array([text[part * chunk : end]]), pa.array([text[end : end + longest - 1]])], names=["doc_id", "tkey", "part", "parts", "text", "ahead"])

    return cut


def _per_chunk(shared, fields: list[str], make, names: list[str], types: list):
    """mapInArrow function that calls ``make`` with the chunk and further columns of a row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_for(*shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 16):
                rows = batch.slice(at, 16).to_pylist()
                made = [make(Chunk(encoder, r["text"], r["ahead"], r["part"] == 0), r) for r in rows]
                keep = [batch.slice(at, 16).column(f) for f in fields]
                yield pa.RecordBatch.from_arrays([*keep, *[pa.array([m[i] for m in made], t) for i, t in enumerate(types)]], names=[*fields, *names])

    return run


def _long_texts(pieces: DataFrame, shared, scratch: Scratch) -> DataFrame:
    """Rows of doc_id, part, parts, ids, exact for the chunks of long texts."""
    width = shared.value[1].longest
    one = pieces.select("tkey", "part", "parts", "text", "ahead").dropDuplicates(["tkey", "part"])
    most = pieces.agg(F.max("parts")).first()[0]
    if most is None:
        return pieces.sparkSession.createDataFrame([], "doc_id long, part long, parts long, ids array<int>, exact boolean")
    levels = 1
    while FAN**levels < most:
        levels += 1
    matrices = one.withColumn("node", F.col("part")).mapInArrow(
        _per_chunk(shared, ["tkey", "node"], lambda c, r: (c.matrix().tobytes(),), ["m"], [pa.binary()]), _NODE + ", m binary")
    matrices = scratch.keep(matrices, "matrices")
    start = np.full(width, NEVER, dtype=np.int64)
    start[0] = 0
    sums = scratch.keep(_scan(matrices, levels, _merge_sums, _spread_sums, start.tobytes(), scratch, "sums")
                        .select(F.col("tkey").alias("_k"), F.col("node").alias("_n"), F.col("v").alias("sums")), "sums")
    reached = pieces.join(sums, (F.col("tkey") == F.col("_k")) & (F.col("part") == F.col("_n"))).drop("_k", "_n")
    ways = reached.dropDuplicates(["tkey", "part"]).withColumn("node", F.col("part")).mapInArrow(
        _per_chunk(shared, ["tkey", "node"], lambda c, r: (c.ways_in(np.frombuffer(r["sums"], np.int64)).tobytes(),), ["m"], [pa.binary()]), _NODE + ", m binary")
    ways = scratch.keep(ways, "ways")
    outs = scratch.keep(_scan(ways, levels, _merge_ways, _spread_ways, b"\0", scratch, "outs")
                        .select(F.col("tkey").alias("_k"), F.col("node").alias("_n"), F.col("v").alias("way")), "outs")
    ready = reached.join(outs, (F.col("tkey") == F.col("_k")) & (F.col("part") == F.col("_n"))).drop("_k", "_n")

    def traced(chunk: Chunk, row: dict) -> tuple:
        sums_, way = np.frombuffer(row["sums"], np.int64), row["way"][0]
        ids = chunk.trace(sums_, way)
        begin = int(chunk.ways_in(sums_)[way])
        text = row["text"] + row["ahead"]
        lead = 1 if row["part"] == 0 else 0
        back = chunk.encoder.lexicon.decode(ids.tolist(), row["part"] == 0)
        return ids, back == text[max(begin - lead, 0) : chunk.size - lead + way]

    return ready.mapInArrow(_per_chunk(shared, ["doc_id", "part", "parts"], traced, ["ids", "exact"], [pa.list_(pa.int32()), pa.bool_()]),
                            "doc_id long, part long, parts long, ids array<int>, exact boolean")


def encoded(docs: DataFrame, model: str = MODEL, chunk: int = CHUNK) -> DataFrame:
    """doc_id, part, parts, ids and ``exact`` (the ids decode to the text of the part), a row per part of a text.

    Texts of fewer than two chunks have one part.  The parts of a text in order hold all of its ids.
    """
    lexicon = Lexicon.load(model)
    if chunk < 2 * lexicon.longest:
        raise ValueError("a chunk must be longer than any piece")
    text_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((model, lexicon))  # the vocabulary file: a fixed size
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole().alias("_t"))
    is_long = F.length("_t") >= 2 * chunk

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_for(*shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                texts = part.column("_t").to_pylist()
                ids = encoder.encode(texts)
                exact = [encoder.lexicon.decode(i.tolist()) == t for i, t in zip(ids, texts, strict=True)]
                n = part.num_rows
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array([0] * n, pa.int64()), pa.array([1] * n, pa.int64()),
                                                  pa.array(ids, pa.list_(pa.int32())), pa.array(exact)], names=["doc_id", "part", "parts", "ids", "exact"])

    at_once = rows.filter(~is_long).mapInArrow(short, "doc_id long, part long, parts long, ids array<int>, exact boolean")
    scratch = Scratch(docs.sparkSession)
    pieces = scratch.keep(rows.filter(is_long).withColumn("tkey", F.md5("_t")).mapInArrow(_cut(lexicon.longest, chunk), _PIECE), "pieces")
    return at_once.unionByName(_long_texts(pieces, shared, scratch))


def decoded(parts: DataFrame, model: str = MODEL) -> DataFrame:
    """doc_id and text from rows of doc_id, part, parts and ids, as :func:`encoded` makes them; the way back for tables.

    Every part is decoded on its own, as no character crosses from one to the next, and the parts of a text are joined in order.  A
    repeated row of a text with one part is decoded as often; texts of many parts need an id, and if each of their parts
    is there n times, the text comes n times.  A text that lacks a part is null; null ids decode to the empty text.
    """
    shared = parts.sparkSession.sparkContext.broadcast(Lexicon.load(model))  # the vocabulary file: a fixed size
    text_batches(parts.sparkSession)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, first = batch.column("ids").to_pylist(), batch.column("part").to_pylist()
            texts = [shared.value.decode(i or [], p == 0) for i, p in zip(ids, first, strict=True)]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("doc_id", "part", "parts")], pa.array(texts, pa.string())], names=["doc_id", "part", "parts", "text"])

    rows = parts.select(*[F.col(c).cast("long").alias(c) for c in ("doc_id", "part", "parts")], F.col("ids").cast("array<int>").alias("ids"))
    texts = rows.mapInArrow(decode, "doc_id long, part long, parts long, text string")
    many = texts.filter("parts > 1").groupBy("doc_id", "part").agg(F.min("text").alias("text"), F.max("parts").alias("parts"), F.count(F.lit(1)).alias("n"))
    # the group is one text
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "text"))), lambda x: x["text"]), "")
    many = many.groupBy("doc_id").agg(F.when(F.count(F.lit(1)) == F.max("parts"), joined).alias("text"), F.min("n").cast("int").alias("n"))
    many = many.select("doc_id", "text", F.explode(F.array_repeat(F.lit(0), F.col("n"))).alias("_")).drop("_")
    return texts.filter("parts = 1").select("doc_id", "text").unionByName(many)


def report(docs: DataFrame, **settings) -> DataFrame:
    """A row per part: doc_id, part, parts, n_tokens, ids, exact."""
    return encoded(docs, **settings).select("doc_id", "part", "parts", F.size("ids").cast("long").alias("n_tokens"), "ids", "exact")
