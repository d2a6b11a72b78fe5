"""Fill-in-middle: a text is cut at two line ends and its parts are put in another order between marks.

A line is everything up to and with a line feed, or what is left at the end.  Cuts are found in words of eight bytes:

1. the UTF-8 bytes of a whole Arrow batch are viewed as ``uint64`` without a copy of single texts;
2. line feeds are marked by arithmetic on words (``0x80`` in the byte of every line feed, nothing elsewhere), code points
   likewise (bytes that do not continue a character);
3. ``bitwise_count`` gives the marks of a word, a running sum those before it;
4. the end of line ``k`` is searched in the running sums, which names its word, and resolved inside the word by clearing
   the lower marks and counting the bits below the lowest one left.

Where a text is cut and in which order it is put depends on its id alone: ``h1`` to ``h4`` are the first four groups of
eight digits of the SHA-256 of ``<seed>:<id>``.  With ``n`` lines the prefix ends after the smaller of ``h1 % (n + 1)`` and
``h2 % (n + 1)`` lines and the middle after the larger.  Empty texts, texts that hold a mark already, and those with
``h3 % 100 >= rate`` stay plain.  The others become ``spm`` (``<S>`` suffix ``<P>`` prefix ``<M>`` middle) if
``h4 % 100 < spm``, else ``psm`` (``<P>`` prefix ``<S>`` suffix ``<M>`` middle).  :func:`restored` takes an output apart
again; since no mark can begin inside another, the first one found is the one that was written.

Defined cases: a null text is empty and plain; a null id counts as the empty text in the hash; repeated rows get equal results;
an empty table gives an empty result; the columns of the input are kept as they are by ``transformed``, whatever
their names; texts of any length are cut as a whole.  A batch holds at most ``spark.sql.execution.arrow.maxBytesPerBatch``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from siftline.llm.common import whole

SEED, RATE, SPM = 7, 100, 50
MARKS = ("<P>", "<S>", "<M>")
_LOW, _HIGH, _ONES = np.uint64(0x7F7F7F7F7F7F7F7F), np.uint64(0x8080808080808080), np.uint64(0x0101010101010101)
_WORDS_AT_ONCE = 1 << 20


def ending(words: np.ndarray, unit_end: int = 0x0A) -> np.ndarray:
    """0x80 in every byte that equals ``unit_end``: after the exclusive or only such a byte has no bit set."""
    x = words ^ (_ONES * np.uint64(unit_end))
    return ~(((x & _LOW) + _LOW) | x | _LOW)


def leading(words: np.ndarray) -> np.ndarray:
    """0x80 in every byte that begins a character: not of the form 10xxxxxx."""
    return ~words & _HIGH | words & (words << np.uint64(1)) & _HIGH


class Marked:
    """Marked bytes of a buffer, with the number of marks before every word."""

    def __init__(self, words: np.ndarray, marking):
        self.marks = np.empty_like(words)
        for at in range(0, words.size, _WORDS_AT_ONCE):  # the arithmetic needs a few arrays of the size of its input
            self.marks[at : at + _WORDS_AT_ONCE] = marking(words[at : at + _WORDS_AT_ONCE])
        self.before = np.zeros(words.size + 1, dtype=np.int64)
        np.cumsum(np.bitwise_count(self.marks), out=self.before[1:])

    def rank(self, ends: np.ndarray) -> np.ndarray:
        """Number of marked bytes before each byte position."""
        word = ends >> 3
        inside = (np.uint64(1) << ((ends & 7) << 3).astype(np.uint64)) - np.uint64(1)
        own = self.marks[np.minimum(word, max(self.marks.size - 1, 0))] if self.marks.size else np.zeros(ends.size, np.uint64)
        return self.before[word] + np.bitwise_count(own & inside)

    def select(self, numbers: np.ndarray) -> np.ndarray:
        """Position of the marked bytes with these numbers, counted from 1."""
        word = np.searchsorted(self.before, numbers, side="left") - 1
        left = self.marks[word]
        skip = numbers - self.before[word] - 1
        for k in range(7):  # a word has eight bytes, so at most seven lower marks are cleared
            left = np.where(skip > k, left & (left - np.uint64(1)), left)
        below = np.bitwise_count((left & (~left + np.uint64(1))) - np.uint64(1))
        return word * 8 + (below >> 3)


def buffer_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The words of an Arrow column of texts, and the positions of the texts' ends (one more than texts)."""
    kind = np.int64 if pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type) else np.int32
    if len(texts) == 0:
        return np.empty(0, "<u8"), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    places = np.frombuffer(offsets, dtype=kind, count=len(texts) + 1, offset=texts.offset * np.dtype(kind).itemsize).astype(np.int64)
    first, size = int(places[0]), int(places[-1] - places[0])
    padded = np.zeros(-(-size // 8), dtype="<u8")
    if size:
        padded.view(np.uint8)[:size] = np.frombuffer(data, np.uint8, count=size, offset=first)
    return padded, places - first


def cuts(texts: pa.Array, h1: np.ndarray, h2: np.ndarray) -> dict[str, np.ndarray]:
    """Per text the number of lines ``n``, the byte positions ``one`` and ``two`` of its cuts, and the code points of prefix and middle."""
    words, places = buffer_of(texts)
    starts, ends = places[:-1], places[1:]
    lines = Marked(words, ending)
    before = lines.rank(places)
    raw = words.view(np.uint8)
    filled = ends > starts
    open_end = np.zeros(len(starts), dtype=bool)
    open_end[filled] = raw[ends[filled] - 1] != 0x0A
    closed = np.diff(before)
    n = closed + open_end
    at = []
    for k in (np.minimum(h1 % (n + 1), h2 % (n + 1)), np.maximum(h1 % (n + 1), h2 % (n + 1))):
        place = np.where(k == 0, starts, ends)
        inner = (k > 0) & (k <= closed)
        place[inner] = lines.select(before[:-1][inner] + k[inner]) + 1
        at.append(place)
    points = Marked(words, leading)
    edges = [points.rank(p) for p in (starts, *at)]
    return {"n": n, "one": at[0] - starts, "two": at[1] - starts, "prefix_chars": edges[1] - edges[0], "middle_chars": edges[2] - edges[1]}


def arranged(form: str, text: bytes, one: int, two: int) -> bytes:
    p, s, m = (mark.encode() for mark in MARKS)
    if form == "plain":
        return text
    prefix, middle, suffix = text[:one], text[one:two], text[two:]
    return b"".join([p, prefix, s, suffix, m, middle] if form == "psm" else [s, suffix, p, prefix, m, middle])


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made from."""
    p, s, m = MARKS
    body = F.substring(output, F.lit(len(p) + 1), F.length(output))
    inner, outer = F.when(form == "psm", F.lit(s)).otherwise(F.lit(p)), F.lit(m)
    cut = F.locate(s, body), F.locate(p, body)
    first = F.when(form == "psm", cut[0]).otherwise(cut[1])
    head = F.substring(body, F.lit(1), first - 1)
    rest = F.substring(body, first + F.length(inner), F.length(body))
    second = F.position(outer, rest)
    tail, middle = F.substring(rest, F.lit(1), second - 1), F.substring(rest, second + F.length(outer), F.length(rest))
    return F.when(form == "plain", output).when(form == "psm", F.concat(head, middle, tail)).otherwise(F.concat(tail, middle, head))


def numbers(doc_id: str, seed: int) -> list[Column]:
    """h1 to h4 of a row, as long."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


_ADDED = [StructField("n", LongType()), StructField("form", StringType()), StructField("prefix_chars", LongType()),
          StructField("middle_chars", LongType()), StructField("output", StringType())]


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, form = batch.column("_t"), batch.column("_form")
        found = cuts(texts, np.asarray(batch.column("_h1")), np.asarray(batch.column("_h2")))
        forms = form.to_pylist()
        made = (arranged(f, t, a, b) for f, t, a, b in zip(forms, texts.cast(pa.binary()).to_pylist(), found["one"].tolist(), found["two"].tolist(), strict=True))
        plain = np.array([f == "plain" for f in forms], dtype=bool)
        columns = [batch.column("_doc"), pa.array(found["n"]), form, *(pa.array(found[c], mask=plain) for c in ("prefix_chars", "middle_chars")),
                   pa.array(made, pa.binary()).view(pa.string())]
        yield pa.RecordBatch.from_arrays(columns, names=["_doc", *(f.name for f in _ADDED)])


def transformed(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", seed: int = SEED, rate: int = RATE, spm: int = SPM) -> DataFrame:
    """The rows of ``docs`` packed as ``_doc``, with n, form, prefix_chars, middle_chars and output."""
    h = numbers(doc_id, seed)
    held = F.lit(False)
    for mark in MARKS:
        held = held | F.contains(whole(text), F.lit(mark))
    plain = (whole(text) == "") | held | (h[2] % 100 >= rate)
    form = F.when(plain, "plain").when(h[3] % 100 < spm, "spm").otherwise("psm")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text]).alias("_doc"), whole(text).alias("_t"),
                       h[0].alias("_h1"), h[1].alias("_h2"), form.alias("_form"))
    return rows.mapInArrow(_cut, StructType([rows.schema["_doc"], *_ADDED]))


def report(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n, form, prefix_chars, middle_chars and the digests of the output and of the text restored from it."""
    rows = transformed(docs.select("doc_id", "text"))
    return rows.select(F.col("_doc.doc_id").alias("doc_id"), "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


SQL = r"""WITH t AS (SELECT doc_id, coalesce(text,'') AS text, regexp_extract_all(coalesce(text,''), '[^\n]*\n|[^\n]+') AS u,
  sha256('7:' || coalesce(doc_id::VARCHAR,'')) AS h FROM documents),
k AS (SELECT *, len(u) AS n, ('0x'||h[1:8])::BIGINT AS h1, ('0x'||h[9:16])::BIGINT AS h2, ('0x'||h[17:24])::BIGINT AS h3, ('0x'||h[25:32])::BIGINT AS h4 FROM t),
c AS (SELECT *, least(h1 % (n+1), h2 % (n+1)) AS a, greatest(h1 % (n+1), h2 % (n+1)) AS b,
  CASE WHEN text = '' OR contains(text,'<P>') OR contains(text,'<S>') OR contains(text,'<M>') OR h3 % 100 >= 100 THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM k),
p AS (SELECT *, array_to_string(u[1:a],'') AS prefix, array_to_string(u[a+1:b],'') AS middle, array_to_string(u[b+1:n],'') AS suffix FROM c)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(prefix) END::BIGINT AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END::BIGINT AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>'||prefix||'<S>'||suffix||'<M>'||middle ELSE '<S>'||suffix||'<P>'||prefix||'<M>'||middle END) AS output_sha256,
  sha256(text) AS restored_sha256 FROM p"""
