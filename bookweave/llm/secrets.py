"""Secret scans with multipart credential linking.

Strong patterns are reported wherever they stand. Weak ones (a bare 40-character key, an account or
client identifier, an endpoint) mean nothing alone: they are interval-joined with the other parts of a
credential within a scope of characters and reported only when the complementary parts co-occur.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bookweave.llm.common import stored, table, text_of

ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: A run that starts with AKIA, or a run of hex digits, is always taken whole, so its least length can stand in the pattern.
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
BARE = r"(?<![A-Za-z0-9+/=_-])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=_-])"
IDENT = r"""(?i)(?<![A-Za-z0-9])(?:account|client|user|app)_?id["']?\x20*[:=]\x20*["']?[A-Za-z0-9-]{4,64}"""
ENDPOINT = r"https?://[A-Za-z0-9.-]{1,253}(?::[0-9]{1,5})?"
#: kind, its rank among spans with one start, pattern, group that must have so many characters.
KINDS = [("assign", ASSIGN, 2, 8), ("access", ACCESS, 0, 0), ("hex", HEX, 0, 0), ("bare", BARE, 0, 0), ("ident", IDENT, 0, 0), ("endpoint", ENDPOINT, 0, 0)]
RANK = {k: i for i, (k, *_) in enumerate(KINDS)}
BASE = ["assign", "access", "hex"]


def _found(kind: str, pattern: str, group: int, least: int) -> Column:
    """Matches in order: the gap before each, its length, and whether it counts."""
    gaps, all_, part = F.split("text", pattern, -1), F.regexp_extract_all("text", F.lit(pattern), F.lit(0)), F.regexp_extract_all("text", F.lit(pattern), F.lit(group))
    return F.transform(
        F.arrays_zip(F.slice(gaps, 1, F.size(all_)).alias("gap"), all_.alias("whole"), part.alias("part")),
        lambda m, i: F.struct(F.lit(kind).alias("kind"), i.alias("i"), F.length(m["gap"]).alias("gap"), F.length(m["whole"]).alias("len"), (F.length(m["part"]) >= least).alias("ok")),
    )


def _spans(docs: DataFrame) -> DataFrame:
    """doc_id, th, kind, start, end of all matches, weak ones included where an identifier stands in the text."""
    has_ident = F.col("text").contains("AKIA") | F.col("text").rlike(IDENT)
    when = {
        "assign": F.col("text").rlike(r"(?i)(?:password|passwd|secret|token|api_?key)"),
        "access": F.col("text").contains("AKIA"),
        "hex": F.col("text").rlike(HEX),
        "bare": F.col("ident"), "ident": F.col("ident"), "endpoint": F.col("ident") & F.col("text").contains("://"),
    }
    some = docs.filter("text <> ''").withColumn("ident", has_ident).filter(when["assign"] | when["access"] | when["hex"] | F.col("ident"))
    none = F.array().cast("array<struct<kind:string,i:int,gap:int,len:int,ok:boolean>>")
    found = F.concat(*(F.when(when[k], _found(k, p, g, n)).otherwise(none) for k, p, g, n in KINDS))
    each = some.select("doc_id", "th", F.explode_outer(found).alias("m")).select("doc_id", "th", "m.*").filter("i IS NOT NULL").distinct()
    order = W.partitionBy("doc_id", "th", "kind").orderBy("i")
    end = F.sum(F.col("gap") + F.col("len")).over(order.rowsBetween(W.unboundedPreceding, 0))
    return each.withColumn("end", end).filter("ok").select("doc_id", "th", "kind", (F.col("end") - F.col("len")).alias("start"), "end")


def _near(left: DataFrame, right: DataFrame, scope: int) -> DataFrame:
    """Rows of left with a row of right in the same text that begins at most `scope` characters away: an interval join by cells."""
    cell = F.floor(F.col("start") / scope)
    there = right.select("doc_id", "th", F.col("start").alias("s2"), F.explode(F.array(cell - 1, cell, cell + 1)).alias("cell"))
    return left.withColumn("cell", cell).join(
        there.select(F.col("doc_id").alias("d2"), F.col("th").alias("t2"), "s2", F.col("cell").alias("c2")),
        F.col("doc_id").eqNullSafe(F.col("d2")) & (F.col("th") == F.col("t2")) & (F.col("cell") == F.col("c2")) & (F.abs(F.col("start") - F.col("s2")) <= scope),
        "left_semi",
    ).drop("cell")


def find_secrets(docs: DataFrame, scope: int = 512) -> DataFrame:
    """doc_id, th (hash of the text), and the sorted array `spans` of start, rank, kind, end; one row per text that has any.

    Positions are code points, ends exclusive. Strong kinds: assign, access, hex. A bare key is reported
    when an access key or identifier begins within `scope` characters; an identifier when a bare key or an
    assigned secret does; an endpoint when both do. Null and empty texts have no spans; repeated rows are
    one text; spans of several kinds with one start stand in the order of KINDS. Texts are searched whole,
    however long. Other columns are left behind. An empty table gives an empty result.
    """
    keyed = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64("text").alias("th"))
    spans = stored(_spans(keyed), "spans")
    of = lambda *kinds: spans.filter(F.col("kind").isin(*kinds))
    secrets, names = of("bare", "assign"), of("access", "ident")
    linked = (
        _near(of("bare"), names, scope)
        .unionByName(_near(of("ident"), secrets, scope))
        .unionByName(_near(_near(of("endpoint"), names, scope), secrets, scope))
    )
    rank = F.create_map(*(F.lit(x) for kv in RANK.items() for x in kv))[F.col("kind")]
    span = F.struct("start", rank.alias("rank"), "kind", "end")
    return of(*BASE).unionByName(linked).groupBy("doc_id", "th").agg(F.array_sort(F.collect_set(span)).alias("spans"))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def secret_report(docs: DataFrame, scope: int = 512) -> DataFrame:
    """One row per row of docs: counts of the strong kinds, the hash of their list, and the list of all spans."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("th"))
    found = find_secrets(docs, scope).select(F.col("doc_id").alias("d"), F.col("th").alias("t"), "spans")
    all_ = F.coalesce("spans", F.array().cast("array<struct<start:bigint,rank:int,kind:string,end:bigint>>"))
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("bigint").alias(f"n_{k}")
    return (
        rows.join(found, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("th") == F.col("t")), "left")
        .withColumn("spans", all_)
        .select(
            "doc_id", *(count(k) for k in BASE),
            F.sha2(_joined(F.filter("spans", lambda s: s["kind"].isin(*BASE))), 256).alias("base_sha256"),
            _joined(F.col("spans")).alias("spans"),
        )
    )


def op10_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_report(table(spark, sf_dir, "documents"))


def _either(words: str) -> str:
    """The pattern with A-Z in either case; DuckDB's own folding takes other letters too."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in words)


def _kind_sql(kind: str, pattern: str, text: str = "text", ok: str = "true", core: int = 0) -> str:
    """Matches of a kind: gap and length in order, whether it counts, and the length of its core (a group, or all)."""
    return f"""SELECT rid, '{kind}' AS kind, {RANK[kind]} AS rank, generate_subscripts(a, 1) AS i, length(unnest(g[1 : len(a)])) AS gap, length(unnest(a)) AS len, length(unnest(c)) AS core, unnest(list_transform(p, lambda x: {ok})) AS ok
  FROM (SELECT rid, regexp_split_to_array({text}, '{pattern}') AS g, regexp_extract_all({text}, '{pattern}', 0) AS a, regexp_extract_all({text}, '{pattern}', {core}) AS c, regexp_extract_all({text}, '{pattern}', {1 if kind == 'assign' else 0}) AS p FROM d)"""


_QUOTE = """["'']?"""
_GIVEN = rf"{_QUOTE}\x20*[:=]\x20*{_QUOTE}"
_NEAR = "EXISTS (FROM s y WHERE y.rid = x.rid AND y.kind IN ({}) AND abs(y.start - x.start) <= 512)"
_NAMES, _KEYS = _NEAR.format("'access', 'ident'"), _NEAR.format("'bare', 'assign'")
_SPAN = "concat_ws(':', kind, start, stop)"

#: Without look-behind: bare keys are whole runs of their letters and marks, and identifiers take the character before them along.
ORACLE = {
    "op10_secret_scans": f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
m AS ({_kind_sql('assign', f"(?:{_either('password|passwd|secret|token|api_?key')}){_GIVEN}([A-Za-z0-9+/_.=-]+)", ok='length(x) >= 8')}
  UNION ALL {_kind_sql('access', ACCESS)}
  UNION ALL {_kind_sql('hex', HEX)}
  UNION ALL {_kind_sql('bare', '[A-Za-z0-9+/=_-]+', ok="regexp_full_match(x, '[A-Za-z0-9+/]{40}')")}
  UNION ALL {_kind_sql('ident', f"[^A-Za-z0-9]((?:{_either('account|client|user|app')})_?{_either('id')}{_GIVEN}[A-Za-z0-9-]{{4,64}})", text="' ' || text", core=1)}
  UNION ALL {_kind_sql('endpoint', ENDPOINT)}),
z AS (SELECT *, CAST(sum(gap + len) OVER (PARTITION BY rid, kind ORDER BY i) AS BIGINT) - CASE WHEN kind = 'ident' THEN 1 ELSE 0 END AS stop FROM m),
s AS (SELECT rid, kind, rank, stop - core AS start, stop FROM z WHERE ok),
k AS (SELECT * FROM s x WHERE kind IN ('assign', 'access', 'hex') OR kind = 'bare' AND {_NAMES} OR kind = 'ident' AND {_KEYS} OR kind = 'endpoint' AND {_NAMES} AND {_KEYS}),
r AS (SELECT rid, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
  string_agg({_SPAN}, ',' ORDER BY start, rank) FILTER (kind IN ('assign', 'access', 'hex')) AS base, string_agg({_SPAN}, ',' ORDER BY start, rank) AS spans FROM k GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN r USING (rid)
"""
}
