"""Secret scan with multipart credential linking (DataFrame functions only).

Strong findings (``assign``, ``access``, ``hex``) are read from each text by regular expressions.  Weak candidates, not
reported alone, are short assigned values, bare 40-character keys and endpoints.  Within its scope (``scope`` code
points between the parts, to either side) a weak candidate is reported only when the parts complete each other:

* ``weak_secret`` (an assigned value of 6 to 11 characters, or a bare key) needs an access identifier or an endpoint;
* ``endpoint`` (a URL with user and password place, or an assigned host) needs an access identifier or a secret, strong
  or weak.

The scopes are joined as intervals by range windows over positions, document by document: each candidate sees the
nearest part of each role before and after it, so a text full of candidates costs n log n and no pairs are made.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import materialize, text_column

#: Matches whose places are added up in one go.
RUN = 256
KINDS = ("assign", "access", "hex", "weak_secret", "endpoint")
_KEY = r"(?i:password|passwd|secret|token|api_?key)"
ASSIGN = _KEY + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"  # runs are maximal: equal to all AKIA[A-Z0-9]+ of 18 characters or more
HEX = r"[0-9a-f]{16,}"
BARE = r"(?<![A-Za-z0-9+/_.=-])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/_.=-])"
ENDPOINT = r"""(?i:https?|ftp|jdbc:[a-z0-9]+|postgres(?:ql)?|mysql|mongodb|redis|amqp|s3)://[A-Za-z0-9._~:@/?%&=+-]+|(?i:host|endpoint|server|url)["']?\x20*[:=]\x20*["']?[A-Za-z0-9.-]+\.[A-Za-z]{2,}"""


def matches(text: Column, pattern: str, group: int = 0) -> Column:
    """Array of (start, end, size) of the leftmost non-overlapping matches: code points, end exclusive; size is the
    length of ``group``.  The pieces between the matches and the matches themselves add up to the positions."""
    none = F.array().cast("array<struct<start:int,end:int,size:int>>")
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    part = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    rows = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), whole.alias("hit"), part.alias("part"))

    def size(r: Column) -> Column:
        return F.length(r["gap"]) + F.coalesce(F.length(r["hit"]), F.lit(0))

    def placed(run: Column) -> Column:
        """The matches of one run of pieces that begins at ``run.at``."""
        def step(acc, r):
            begin = acc["at"] + F.length(r["gap"])
            end = begin + F.length(r["hit"])
            return F.struct(F.coalesce(end, begin).alias("at"), F.when(r["hit"].isNull(), acc["out"]).otherwise(
                F.concat(acc["out"], F.array(F.struct(begin.alias("start"), end.alias("end"), F.length(r["part"]).alias("size"))))).alias("out"))
        return F.aggregate(run["rows"], F.struct(run["at"].alias("at"), none.alias("out")), step, lambda acc: acc["out"])

    def in_runs(pieces: Column) -> Column:
        """Arrays grow by copying, so the pieces are taken in runs of ``RUN``: each run's length, its start, its matches."""
        starts = F.sequence(F.lit(1), F.size(pieces), F.lit(RUN))
        runs = F.transform(starts, lambda i: F.struct(F.slice(pieces, i, F.lit(RUN)).alias("rows")))
        return _let(runs, lambda runs: _let(F.transform(runs, lambda r: F.aggregate(r["rows"], F.lit(0), lambda n, x: n + size(x))), lambda sizes: F.flatten(F.transform(
            F.arrays_zip(runs.alias("run"), _starts(sizes).alias("at")), lambda z: placed(F.struct(z["run"]["rows"].alias("rows"), z["at"].alias("at")))))))

    return F.when(F.regexp_like(text, F.lit(pattern)), _let(rows, in_runs)).otherwise(none)


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _starts(sizes: Column) -> Column:
    """Sums of the sizes before each place."""
    begun = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
    return F.aggregate(sizes, begun, lambda acc, n: F.struct((acc["at"] + n).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")), lambda acc: acc["out"])


def _spans(found: Column, kind: int, keep) -> Column:
    return F.transform(F.filter(found, keep), lambda m: F.struct(m["start"].alias("start"), F.lit(kind).alias("kind"), m["end"].alias("end")))


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.sort_array(spans), lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan_secrets(df: DataFrame, doc_id: str = "doc_id", text: str = "text", scope: int = 200) -> DataFrame:
    """One row per input row: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_linked and ``links`` (each linked
    weak candidate with the nearest part that completes it).

    Null text counts as empty; texts without findings have counts 0, the hash of the empty string and empty spans.
    Rows are independent: repeated rows and repeated doc_ids each get their row.  Other columns are not read.  An empty
    table gives no rows."""
    base = df.select(F.col(doc_id).alias("doc_id"), text_column(df, text).alias("t"))
    assign = matches(F.col("t"), ASSIGN, 1)
    every = (lambda m: F.lit(True))
    rows = base.select("doc_id", assign.alias("a"), _spans(matches(F.col("t"), ACCESS), 1, every).alias("access"), _spans(matches(F.col("t"), HEX), 2, every).alias("hex"),
                       matches(F.col("t"), BARE).alias("bare"), _spans(matches(F.col("t"), ENDPOINT), 4, every).alias("endpoint"))
    found = materialize(rows.select(
        F.monotonically_increasing_id().alias("rid"), "doc_id", _spans(F.col("a"), 0, lambda m: m["size"] >= 12).alias("assign"), "access", "hex",
        F.concat(_spans(F.col("a"), 3, lambda m: (m["size"] >= 6) & (m["size"] < 12)), _spans(F.col("bare"), 3, every)).alias("weak"), "endpoint"), "secrets")
    spans = found.filter((F.size("weak") + F.size("endpoint") > 0)).select("rid", F.explode(F.concat("assign", "access", "hex", "weak", "endpoint")).alias("s"))
    linked = materialize(link_parts(spans.select("rid", "s.start", "s.kind", "s.end").distinct(), scope), "secret-links")
    linked = linked.groupBy("rid").agg(F.sort_array(F.collect_list(F.struct("start", "kind", "end", "partner_start", "partner_kind"))).alias("links"))
    base_spans = F.concat("assign", "access", "hex")
    out = found.join(linked, "rid", "left").withColumn("links", F.coalesce("links", F.array().cast("array<struct<start:int,kind:int,end:int,partner_start:int,partner_kind:int>>")))
    extra = F.transform("links", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    return out.select("doc_id", F.size("assign").cast("long").alias("n_assign"), F.size("access").cast("long").alias("n_access"), F.size("hex").cast("long").alias("n_hex"),
                      F.sha2(_joined(base_spans).cast("binary"), 256).alias("base_sha256"), _joined(F.concat(base_spans, extra)).alias("spans"),
                      F.size("links").cast("long").alias("n_linked"), "links")


def link_parts(spans: DataFrame, scope: int) -> DataFrame:
    """``spans``: rid, start, kind, end.  The weak candidates whose scope holds a complementary part, with the nearest.

    Distances are from the end of the earlier part to the start of the later one (0 where they touch or overlap), whatever
    the parts' lengths."""
    begun = Window.partitionBy("rid").orderBy("start").rangeBetween(Window.unboundedPreceding, 0)
    ahead = Window.partitionBy("rid").orderBy(F.desc("start")).rangeBetween(Window.unboundedPreceding, 0)

    def nearest(kinds: list[int]) -> Column:
        mine = F.col("kind").isin(kinds)   # of the parts that begin before or here the largest end, of those from here on the first start
        b, a = F.max(F.when(mine, F.struct("end", "start", "kind"))).over(begun), F.min(F.when(mine, F.struct("start", "kind"))).over(ahead)
        to_b, to_a = F.when(b.isNotNull(), F.greatest(F.col("start") - b["end"], F.lit(0))), F.when(a.isNotNull(), F.greatest(a["start"] - F.col("end"), F.lit(0)))
        b, a = F.when(to_b <= scope, F.struct(b["start"].alias("start"), b["kind"].alias("kind"))), F.when(to_a <= scope, a)
        return F.when(a.isNull() | (b.isNotNull() & (to_b <= to_a)), b).otherwise(a)

    access, secret, endpoint = nearest([1]), nearest([0, 2, 3]), nearest([4])
    partner = F.when(F.col("kind") == 3, F.coalesce(access, endpoint)).when(F.col("kind") == 4, F.coalesce(access, secret))
    return (spans.withColumn("p", partner).filter(F.col("p").isNotNull())
            .select("rid", "start", "kind", "end", F.col("p.start").alias("partner_start"), F.col("p.kind").alias("partner_kind")))
