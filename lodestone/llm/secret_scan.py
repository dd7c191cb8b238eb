r"""Secret scans with corpus-wide ownership frequency.

Candidates are found per text with regular expressions; their positions come
from the lengths of the matches and of the pieces between them (Spark's
``split`` and ``regexp_extract_all`` walk the same matches). Base kinds:

* assign: a keyword, ``:`` or ``=`` and a value of 6 or more characters
* access: ``AKIA`` and capitals or digits, 20 or more characters in all
* hex: 24 or more lower-case hex digits

Beyond these, ``token`` candidates (long mixed-case strings with a digit) are
judged by ownership: candidate hashes are counted by distinct repositories and
owners over the whole corpus. A token of few owners that few repositories hold
looks live and is added; one that many owners share, or that one owner has copied into
many repositories, is an example. Every span carries that verdict (``live``),
base spans stay in any case. An owner is a source and a repository a document,
unless the caller names other columns.

Only rows with matches are exploded; hashes are made distinct per (hash,
repository, owner) map-side, so a widely copied example is one partial row a
task and owner. Null text: empty. Null owner or repository is one of its own.
Repeated rows add nothing to the counts. Only DataFrame functions run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.llm.common import stored

# fixed values: the candidate patterns, in the order of their kinds
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
TOKEN = r"[A-Za-z0-9_-]{20,}"
KINDS = ("assign", "access", "hex", "token")

STEP = "array<struct<kind:int,pos:int,gap:int,size:int,value:string>>"


def _find(text: Column, kind: int, pattern: str, value_group: int) -> Column:
    """All matches in their order: the characters before each (since the last one), its size and its value."""
    whole = F.regexp_extract_all(text, F.lit(pattern), 0)
    value = F.regexp_extract_all(text, F.lit(pattern), value_group) if value_group else whole
    between = F.split(text, pattern, -1)
    steps = F.arrays_zip(F.transform(whole, F.length).alias("size"), F.transform(between, F.length).alias("gap"), value.alias("value"))
    steps = F.filter(steps, lambda x: x["size"].isNotNull())  # the last piece has no match behind it
    found = F.transform(steps, lambda x, i: F.struct(F.lit(kind).alias("kind"), i.alias("pos"), x["gap"].alias("gap"), x["size"].alias("size"), x["value"].alias("value")))
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast(STEP))


def matches(text: Column) -> Column:
    text = F.coalesce(text, F.lit(""))
    return F.concat(_find(text, 0, ASSIGN, 2), _find(text, 1, ACCESS, 0), _find(text, 2, HEX, 0), _find(text, 3, TOKEN, 0))


def candidates(found: DataFrame, keep: list[str]) -> DataFrame:
    """One row per candidate of rows (row, keep..., matches): kind, start, end
    (code points, end exclusive) and value. Positions are running sums over a
    row's matches of a kind, so a text of very many matches costs their number."""
    each = found.where(F.size("matches") > 0).select("row", *keep, F.explode("matches").alias("m")).select("row", *keep, "m.*")
    to_here = Window.partitionBy("row", "kind").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    each = each.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(to_here).cast("int"))
    value = F.col("value")
    mixed = value.rlike("[0-9]") & value.rlike("[a-z]") & value.rlike("[A-Z]")
    ok = F.when(F.col("kind") == 0, F.length("value") >= 6).when(F.col("kind") == 3, mixed).otherwise(True)
    return each.where(ok).select("row", *keep, "kind", (F.col("end") - F.col("size")).alias("start"), "end", "value")


def scan(docs: DataFrame, repository: Column | None = None, owner: Column | None = None, max_owners: int = 2, max_repositories: int = 5) -> DataFrame:
    """One row per document: doc_id and ``spans``, an array of (start, kind,
    end, n_owners, n_repositories, live) by start, then kind. A value is live if at most
    ``max_owners`` owners and at most ``max_repositories`` repositories hold it."""
    owner = F.col("source") if owner is None else owner
    repository = F.col("doc_id") if repository is None else repository
    d = docs.select("doc_id", owner.alias("owner"), repository.cast("string").alias("repository"), matches(F.col("text")).alias("matches"))
    d = stored(d.withColumn("row", F.monotonically_increasing_id()), "secrets")
    each = candidates(d, ["owner", "repository"]).withColumn("hash", F.sha2("value", 256)).drop("value")
    held = each.groupBy("hash", "repository", "owner").agg(F.lit(1).alias("x"))
    owners = held.groupBy("hash", "owner").agg(F.lit(1).alias("x")).groupBy("hash").agg(F.count("*").alias("n_owners"))
    repos = held.groupBy("hash", "repository").agg(F.lit(1).alias("x")).groupBy("hash").agg(F.count("*").alias("n_repositories"))
    # stored, so that the join has a shuffle of its own, whose hot hashes can be split
    judged = each.join(stored(owners.join(repos, "hash"), "owners"), "hash")
    live = (F.col("n_owners") <= max_owners) & (F.col("n_repositories") <= max_repositories)
    spans = judged.withColumn("live", live).where((F.col("kind") < 3) | F.col("live")).groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct("start", "kind", "end", "n_owners", "n_repositories", "live"))).alias("found"))
    return d.select("row", "doc_id").join(spans, "row", "left").drop("row").withColumnRenamed("found", "spans")


def _text(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def op9(docs: DataFrame) -> DataFrame:
    d = scan(docs)
    spans = F.coalesce(F.col("spans"), F.array().cast("array<struct<start:int,kind:int,end:int,n_owners:bigint,n_repositories:bigint,live:boolean>>"))
    d = d.select("doc_id", spans.alias("spans"))
    # a lambda of two parameters would be given the index
    of_kind = lambda i: F.size(F.filter("spans", lambda s: s["kind"] == i)).cast("long")
    n = {f"n_{k}": of_kind(i) for i, k in enumerate(KINDS[:3])}
    base = _text(F.filter("spans", lambda s: s["kind"] < 3))
    return d.select("doc_id", *[c.alias(k) for k, c in n.items()], F.sha2(base, 256).alias("base_sha256"), _text(F.col("spans")).alias("spans"),
                    F.size(F.filter("spans", lambda s: s["live"])).cast("long").alias("n_live"))
