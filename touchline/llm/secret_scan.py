"""Operator 1: secret scan with multipart credential linking, in Spark functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stash, text_of

#: kind: pattern, group whose length counts (0: the whole match), least length.  In the order of the kinds.
BASE = {
    "assign": (r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    "access": (r"AKIA[A-Z0-9]+", 0, 20),
    "hex": (r"[0-9a-f]+", 0, 24),
}
WEAK = {
    "weak": (r"(?<![A-Za-z0-9+/=_-])(?=[A-Za-z+/_-]*+[0-9])(?=[0-9+/_-]*+[A-Za-z])[A-Za-z0-9+/_-]{20,}+={0,2}", 0, 20),
    "identifier": (r"""(?i)(?:\b(?:user(?:name|_?id)?|login|account|client_?id|key_?id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9._@-]{3,}|(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++)""", 0, 3),
    "endpoint": (r"""(?i)(?:(?<![a-z0-9+.-])[a-z][a-z0-9+.-]*+://[^\s"'<>]++|(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?::[0-9]{1,5})?(?![0-9.]))""", 0, 7),
}
#: Cheaper patterns without which the dear ones cannot match.
GUARD = {"hex": r"[0-9a-f]{24}", "weak": r"[A-Za-z0-9+/_-]{20}", "identifier": r"(?i)[@:=]", "endpoint": r"://|[0-9]\.[0-9]"}
KINDS = [*BASE, *WEAK]
#: Code points between the starts of parts that belong to one credential.
SCOPE = 400


def matches(text: Column, kind: str) -> Column:
    """array<struct<gap, length, counted>>: for each match of the pattern the
    code points since the one before, its own, and those that must be enough."""
    pattern, group, _ = (BASE | WEAK)[kind]
    p = F.lit(pattern)
    found = F.arrays_zip(
        F.transform(F.split(text, pattern, -1), F.length).alias("gap"),
        F.transform(F.regexp_extract_all(text, p, F.lit(0)), F.length).alias("length"),
        F.transform(F.regexp_extract_all(text, p, F.lit(group)), F.length).alias("counted"),
    )
    return F.when(text.rlike(GUARD.get(kind, pattern)), F.filter(found, lambda m: m["length"].isNotNull()))


def spans_of(docs: DataFrame) -> DataFrame:
    """rid, doc_id, kind, rank, start, end of every span of columns m_<kind>.

    Starts are running sums over a row's matches of one kind: linear in them.
    """
    one = [docs.select("rid", "doc_id", F.lit(kind).alias("kind"), F.lit(rank).alias("rank"), F.posexplode(f"m_{kind}").alias("i", "m")).where("m.length is not null") for rank, kind in enumerate(KINDS)]
    spans = one[0]
    for more in one[1:]:
        spans = spans.union(more)
    upto = Window.partitionBy("rid", "rank").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("m.gap").cast("long") + F.col("m.length")).over(upto)
    enough = F.lit(0)
    for rank, kind in enumerate(KINDS):
        enough = F.when(F.col("rank") == rank, (BASE | WEAK)[kind][2]).otherwise(enough)
    return spans.select("rid", "doc_id", "kind", "rank", (end - F.col("m.length")).alias("start"), end.alias("end"), (F.col("m.counted") >= enough).alias("ok")).where("ok").drop("ok")


def linked(spans: DataFrame, scope: int) -> DataFrame:
    """Base spans, and the weak candidates with complementary parts in scope.

    An interval semi-join by nearest neighbours: the last part of each role at
    or before a span and the first one after it, found by two windows over the
    row's spans; no pairs are made.  A weak secret needs an identifier within
    ``scope``, an identifier needs a secret, an endpoint needs both.  A weak
    secret inside or across a base span is that span again and is left out.
    """
    role = {"secret": F.col("kind").isin("assign", "hex", "weak"), "identifier": F.col("kind").isin("access", "identifier"), "endpoint": F.col("kind") == "endpoint"}
    order = ["start", "rank", "end"]
    before = Window.partitionBy("rid").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy("rid").orderBy(*(F.desc(c) for c in order)).rowsBetween(Window.unboundedPreceding, -1)
    base = F.col("rank") < len(BASE)
    out = spans.withColumn("base_to", F.max(F.when(base, F.col("end"))).over(before)).withColumn("base_from", F.min(F.when(base, F.col("start"))).over(after))
    doubled = (F.col("kind") == "weak") & (F.coalesce(F.col("base_to") > F.col("start"), F.lit(False)) | F.coalesce(F.col("base_from") < F.col("end"), F.lit(False)))
    out = out.where(~doubled)
    for name in ("secret", "identifier"):
        start = F.when(role[name], F.col("start"))
        out = out.withColumn(f"{name}_before", F.max(start).over(before)).withColumn(f"{name}_after", F.min(start).over(after))
    near = {n: F.coalesce(F.col("start") - F.col(f"{n}_before") <= scope, F.lit(False)) | F.coalesce(F.col(f"{n}_after") - F.col("start") <= scope, F.lit(False)) for n in ("secret", "identifier")}
    wanted = base | ((F.col("kind") == "weak") & near["identifier"]) | ((F.col("kind") == "identifier") & near["secret"]) | (role["endpoint"] & near["secret"] & near["identifier"])
    return out.where(wanted).select("rid", "doc_id", "kind", "rank", "start", "end")


def numbered(spans: DataFrame, scope: int) -> DataFrame:
    """``spans`` with credential: parts within ``scope`` of each other, directly
    or through parts between them, belong to one credential of their row.  On a
    line these are the runs between wider gaps: a running sum, no pairs."""
    order = Window.partitionBy("rid").orderBy("start", "rank", "end")
    opens = F.coalesce(F.col("start") - F.lag("start").over(order) > scope, F.lit(True)).cast("int")
    return spans.withColumn("opens", opens).withColumn("credential", F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, 0))).drop("opens")


def scan(docs: DataFrame, scope: int = SCOPE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, credentials of every row.

    ``credentials`` has a number for each span, in the order of ``spans``: spans
    of one number were found in one scope and belong together.

    The texts are read once: what is kept of them, the lengths of matches and
    gaps, is written and cut apart, and only rows with matches are shuffled, by
    a row number.  Null texts count as empty; a row without spans has the digest
    of the empty string, empty spans and credentials; repeated rows give repeated results;
    an empty table gives an empty one; other columns are ignored.
    """
    own = docs.select(docs[id_col].cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    found = own.select(F.monotonically_increasing_id().alias("rid"), "doc_id", *(matches(F.col("text"), k).alias(f"m_{k}") for k in KINDS))
    found = stash(found)
    some = F.lit(False)
    for kind in KINDS:
        some = some | (F.coalesce(F.size(f"m_{kind}"), F.lit(0)) > 0)
    every = F.array_sort(F.collect_list(F.struct("start", "rank", "end", "kind", "credential")))
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    grouped = numbered(linked(spans_of(found.where(some)), scope), scope).groupBy("rid").agg(*(F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in BASE), every.alias("all"))
    hits = grouped.select("rid", *(f"n_{k}" for k in BASE), F.sha2(text(F.filter("all", lambda s: s["rank"] < len(BASE))), 256).alias("base_sha256"), text(F.col("all")).alias("spans"), F.array_join(F.transform("all", lambda s: s["credential"].cast("string")), ",").alias("credentials"))
    zero = {f"n_{k}": F.lit(0).cast("long") for k in BASE} | {"base_sha256": F.sha2(F.lit("").cast("binary"), 256), "spans": F.lit(""), "credentials": F.lit("")}
    rows = found.where(some).select("rid", "doc_id").join(hits, "rid", "left").select("doc_id", *(F.coalesce(c, v).alias(c) for c, v in zero.items()))
    return rows.unionByName(found.where(~some).select("doc_id", *(v.alias(c) for c, v in zero.items())))
