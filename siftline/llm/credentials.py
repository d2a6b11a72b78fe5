"""Secret scan with linking of the parts of a credential.

Main path in DataFrame functions only.  Three strong kinds are reported wherever they match.  Three weak kinds (an account
identifier, a bare string of forty base64 characters, an endpoint) say little alone: they are reported only when the
parts that complete them start within ``SCOPE`` code points in the same text.  An identifier needs a secret, a secret
needs an identifier, an endpoint needs both.

The parts are joined by intervals: places are cut into cells of ``SCOPE`` code points, each cell keeps the first and the
last place of every class, and a weak part looks at its own cell and its two neighbours.  Anything in the own cell is near;
of a neighbour the nearest place decides.  So no pairs are made, however many parts a text has.

Defined cases: a null text is empty and has no spans; repeated rows get equal results; an empty table gives an empty
result; other columns are ignored; ids may be null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from siftline.llm.common import Scratch, whole

SCOPE = 256
PIECE = 256  # matches that are placed together
KINDS = ("assign", "access", "hex", "secret", "identifier", "endpoint")
_VALUE = r"""["']?\x20*[:=]\x20*["']?"""
# kind: pattern, group whose length counts, smallest and largest length
PATTERNS = {
    "assign": (r"((?i:password|passwd|secret|token|api_?key))" + _VALUE + r"([A-Za-z0-9+/_.=-]+)", 2, 6, None),
    "access": (r"AKIA[A-Z0-9]+", 0, 20, None),
    "hex": (r"[0-9a-f]{24,}", 0, 24, None),
    "secret": (r"[A-Za-z0-9+/]{40,}", 0, 40, 40),
    "identifier": (r"((?i:client_?id|account_?id|access_?id|user_?id|user_?name))" + _VALUE + r"([A-Za-z0-9._@+-]+)", 2, 3, None),
    "endpoint": (r"https?://[A-Za-z0-9.-]+", 0, 10, None),
}
STRONG, WEAK = KINDS[:3], KINDS[3:]
_SPAN = "array<struct<start:bigint,kind:int,end:bigint>>"


def spans(kind: str, text: str = "_t") -> Column:
    """Matches of one kind as start, place in ``KINDS`` and end.  The texts between matches and the matches themselves
    alternate, so their lengths give the places."""
    pattern, group, least, most = PATTERNS[kind]
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), hits.alias("hit"), F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("value"))
    def step(done: Column, x: Column) -> Column:
        start = done["at"] + F.length(x["gap"])
        end = start + F.coalesce(F.length(x["hit"]), F.lit(0))
        size = F.length(x["value"])
        good = (size >= least) if most is None else (size >= least) & (size <= most)
        span = F.struct(start.cast("bigint").alias("start"), F.lit(KINDS.index(kind)).alias("kind"), end.cast("bigint").alias("end"))
        return F.struct(end.cast("bigint").alias("at"), F.when(good, F.concat(done["found"], F.array(span))).otherwise(done["found"]).alias("found"))

    def fold(p: Column) -> Column:
        """Folded in pieces, each from the place where the one before ends: a list grows to a piece only."""
        def piece(done: Column, i: Column) -> Column:
            start = F.struct(F.element_at(done, -1)["at"].alias("at"), F.array().cast(_SPAN).alias("found"))
            return F.concat(done, F.array(F.aggregate(F.slice(p, i * PIECE + 1, F.lit(PIECE)), start, step)))

        first = F.array(F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(_SPAN).alias("found")))
        pieces = F.aggregate(F.sequence(F.lit(0), ((F.size(p) - 1) / PIECE).cast("int")), first, piece)
        return F.flatten(F.transform(pieces, lambda x: x["found"]))

    return F.when(F.col(text).rlike(pattern), F.transform(F.array(parts), fold)[0]).otherwise(F.array().cast(_SPAN))


def listed(column: str) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.sort_array(column), lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def linked(parts: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Weak parts whose complements start within ``scope``, from rows of _row, kind, start, end."""
    cell = F.floor(F.col("start") / scope)
    is_id = F.col("kind").isin(KINDS.index("access"), KINDS.index("identifier"))
    is_secret = F.col("kind").isin(KINDS.index("assign"), KINDS.index("secret"))
    cells = parts.groupBy("_row", cell.alias("_cell")).agg(
        *[f(F.when(c, F.col("start"))).alias(f"_{n}_{c_name}") for c_name, c in (("id", is_id), ("secret", is_secret)) for n, f in (("low", F.min), ("high", F.max))])
    weak = (parts.filter(F.col("kind") >= len(STRONG)).withColumn("_side", F.explode(F.array(F.lit(-1), F.lit(0), F.lit(1))))
            .withColumn("_cell", cell + F.col("_side")))

    def near(name: str) -> Column:
        return F.max(F.when(F.col("_side") == 0, F.col(f"_low_{name}").isNotNull())
                     .when(F.col("_side") < 0, F.col(f"_high_{name}") >= F.col("start") - scope)
                     .otherwise(F.col(f"_low_{name}") <= F.col("start") + scope))

    met = weak.join(cells, ["_row", "_cell"]).groupBy("_row", "start", "kind", "end").agg(near("id").alias("_id"), near("secret").alias("_secret"))
    has_id, has_secret = F.coalesce("_id", F.lit(False)), F.coalesce("_secret", F.lit(False))
    name = F.element_at(F.array(*[F.lit(k) for k in KINDS]), F.col("kind") + 1)
    return met.filter(F.when(name == "identifier", has_secret).when(name == "secret", has_id).otherwise(has_id & has_secret)).drop("_id", "_secret")


def scan(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Spans of every row of ``docs``: ``base`` (strong kinds) and ``found`` (strong kinds and linked weak parts)."""
    rows = docs.select("doc_id", whole().alias("_t")).select(
        F.monotonically_increasing_id().alias("_row"), "doc_id", *[spans(k).alias(f"_{k}") for k in KINDS])
    rows = rows.select("_row", "doc_id", *[F.size(f"_{k}").cast("long").alias(f"n_{k}") for k in STRONG],
                       F.sort_array(F.concat(*[f"_{k}" for k in STRONG])).alias("base"), F.concat(*[f"_{k}" for k in WEAK]).alias("_weak"))
    rows = Scratch(docs.sparkSession).keep(rows, "spans")
    parts = rows.filter(F.size("_weak") > 0).select("_row", F.explode(F.concat("base", "_weak")).alias("_p")).select("_row", "_p.*")
    added = linked(parts, scope).groupBy("_row").agg(F.collect_list(F.struct("start", "kind", "end")).alias("_added"))
    full = rows.drop("_weak").join(added, "_row", "left")
    return full.withColumn("found", F.sort_array(F.concat("base", F.coalesce("_added", F.array().cast(_SPAN))))).drop("_row", "_added")


def report(docs: DataFrame) -> DataFrame:
    """Counts per strong kind, digest of the strong spans and all spans as text."""
    return scan(docs).select("doc_id", *[f"n_{k}" for k in STRONG], F.sha2(listed("base"), 256).alias("base_sha256"), listed("found").alias("spans"))


def _sql_spans(kind: str) -> str:
    pattern, group, least, most = PATTERNS[kind]
    p = "'" + pattern.replace("'", "''") + "'"
    kept = f"len_value >= {least}" + (f" AND len_value <= {most}" if most else "")
    return f"""SELECT doc_id, {KINDS.index(kind)} AS kind, start, start + len_hit AS end_ FROM (
      SELECT doc_id, list_sum(list_transform(gaps[1:i], lambda g: length(g))) + coalesce(list_sum(list_transform(hits[1:i-1], lambda h: length(h))), 0) AS start,
        length(hits[i]) AS len_hit, length(vals[i]) AS len_value
      FROM (SELECT doc_id, string_split_regex(text, {p}) AS gaps, regexp_extract_all(text, {p}) AS hits, regexp_extract_all(text, {p}, {group}) AS vals
        FROM t WHERE regexp_matches(text, {p})), unnest(range(1, len(hits)+1)) AS u(i)) WHERE {kept}"""


_NAMES = "[" + ",".join(f"'{k}'" for k in KINDS) + "]"
SQL = f"""WITH t AS (SELECT doc_id, coalesce(text,'') AS text FROM documents),
parts AS MATERIALIZED ({' UNION ALL '.join(_sql_spans(k) for k in KINDS)}),
flags AS (SELECT p.*, EXISTS (SELECT 1 FROM parts q WHERE q.doc_id=p.doc_id AND q.kind IN (1,4) AND abs(q.start-p.start) <= {SCOPE}) AS has_id,
  EXISTS (SELECT 1 FROM parts q WHERE q.doc_id=p.doc_id AND q.kind IN (0,3) AND abs(q.start-p.start) <= {SCOPE}) AS has_secret FROM parts p),
found AS (SELECT *, {_NAMES}[kind+1]||':'||start||':'||end_ AS span FROM flags
  WHERE kind < 3 OR (kind = 3 AND has_id) OR (kind = 4 AND has_secret) OR (kind = 5 AND has_id AND has_secret)),
per AS (SELECT doc_id, count(*) FILTER (kind=0) AS a, count(*) FILTER (kind=1) AS b, count(*) FILTER (kind=2) AS c,
  string_agg(span, ',' ORDER BY start, kind) FILTER (kind < 3) AS base, string_agg(span, ',' ORDER BY start, kind) AS spans FROM found GROUP BY doc_id)
SELECT t.doc_id, coalesce(a,0)::BIGINT AS n_assign, coalesce(b,0)::BIGINT AS n_access, coalesce(c,0)::BIGINT AS n_hex,
  sha256(coalesce(base,'')) AS base_sha256, coalesce(spans,'') AS spans FROM t LEFT JOIN per USING (doc_id)"""
