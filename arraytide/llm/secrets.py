"""Secret scans: spans found by patterns inside texts, judged by how many owners and repositories share each candidate.

Everything runs as column expressions. Patterns give the spans (code points, end exclusive); candidate values are hashed and counted over
the corpus by distinct repository and distinct owner. A value that at most `max_owners` owners hold, in at most `max_repositories` of
their repositories, looks live; one that more owners or repositories hold is a copied example. `opaque` runs (32 and more mixed characters with no keyword) are too vague to be secrets by shape alone, so they count only
where the corpus says that they are live; the other kinds count always and carry the verdict in n_live and n_copied.

Defined results: a null text is empty; a null owner or repository is one owner or repository of its own; repeated rows are judged each and
add nothing to distinct counts; an empty table gives an empty result.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arraytide.llm import common

# fixed values: the kinds in their listed order, each with its pattern, the group that is the value, and the least length of that group.
# Of a run of hex digits or of upper-case letters and digits only the whole can match, so the least length can stand in the pattern there.
KINDS = {
    "assign": (r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    "access": (r"AKIA[A-Z0-9]{14,}", 0, 18),
    "hex": (r"[0-9a-f]{16,}", 0, 16),
    "opaque": (r"[A-Za-z0-9+/_-]{32,}", 0, 32),
}
BASE = ("assign", "access", "hex")
OPAQUE = list(KINDS).index("opaque")
SPAN = "array<struct<start:int,kind:int,end:int,value:string>>"


def spans_of(text: Column, kind: str) -> Column:
    """array<struct<start, kind, end, value>> of one kind, leftmost and non-overlapping; `value` is the SHA-256 of the secret part."""
    pattern, group, least = KINDS[kind]
    regex = F.lit(pattern)
    found = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, regex, F.lit(0)).alias("hit"),
                         F.regexp_extract_all(text, regex, F.lit(group)).alias("value"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("out"))

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + F.char_length(x["gap"])
        end = begin + F.coalesce(F.char_length(x["hit"]), F.lit(0))
        counts = F.char_length(x["value"]) >= least
        if kind == "opaque":
            counts = counts & x["value"].rlike("[0-9]") & x["value"].rlike("[A-Z]") & x["value"].rlike("[a-z]")
        one = F.struct(begin.alias("start"), F.lit(list(KINDS).index(kind)).alias("kind"), end.alias("end"), F.sha2(x["value"], 256).alias("value"))
        return F.struct(end.alias("at"), F.when(counts, F.concat(acc["out"], F.array(one))).otherwise(acc["out"]).alias("out"))

    # the cheap test first: most texts hold no match and are scanned once
    return F.when(text.rlike(pattern), F.aggregate(found, start, step, lambda acc: acc["out"])).otherwise(F.array().cast(SPAN))


def _of_kind(i: int):
    return lambda s: s["kind"] == i


def scan(docs: DataFrame, text: str = "text", owner: str = "source", repository: tuple[str, ...] = ("source", "lang"),
         keep: tuple[str, ...] = ("doc_id",), name: str = "secret-spans") -> DataFrame:
    """One row per document with `spans` of all kinds, its owner and its repository, under a row number `uid`; stored."""
    body = common.text_of(text)
    repo = F.to_json(F.struct(*(F.col(c).cast("string").alias(f"r{i}") for i, c in enumerate(repository))))
    t = docs.select(*(F.col(c).alias(f"k_{c}") for c in keep), body.alias("body"), F.col(owner).cast("string").alias("owner"), repo.alias("repository"))
    return common.stored(t.select("*", F.array_sort(F.concat(*(spans_of(F.col("body"), k) for k in KINDS))).alias("spans"))
                         .drop("body").withColumn("uid", F.monotonically_increasing_id()), name)


def ownership(scanned: DataFrame) -> DataFrame:
    """value, n_owners, n_repositories: distinct holders of every candidate. A value in a third of all rows is one row per holder and task."""
    c = scanned.select("owner", "repository", F.explode("spans").alias("s")).select("owner", "repository", F.col("s.value").alias("value"))
    # null holders are told apart from none: the pair is distinct first, then counted
    owners = c.select("value", "owner").distinct().groupBy("value").agg(F.count(F.lit(1)).alias("n_owners"))
    repos = c.select("value", "repository").distinct().groupBy("value").agg(F.count(F.lit(1)).alias("n_repositories"))
    return owners.join(repos, "value")


def judged(scanned: DataFrame, max_owners: int = 1, max_repositories: int = 3) -> DataFrame:
    """uid, spans (start, kind, end): those that count, in order; n_live and n_copied of them. Rows without a candidate are not listed."""
    c = scanned.where(F.size("spans") > 0).select("uid", F.explode("spans").alias("s")).select(
        "uid", F.col("s.start").alias("start"), F.col("s.kind").alias("kind"), F.col("s.end").alias("end"), F.col("s.value").alias("value"))
    c = c.join(ownership(scanned), "value").withColumn("live", (F.col("n_owners") <= max_owners) & (F.col("n_repositories") <= max_repositories))
    c = c.where((F.col("kind") != OPAQUE) | F.col("live"))
    return c.groupBy("uid").agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end"))).alias("spans"),
                                F.count_if("live").alias("n_live"), F.count_if(~F.col("live")).alias("n_copied"))


def written(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(docs: DataFrame, max_owners: int = 1, max_repositories: int = 3, doc_id: str = "doc_id", text: str = "text", owner: str = "source",
           repository: tuple[str, ...] = ("source", "lang")) -> DataFrame:
    """Per document: counts of the base kinds, SHA-256 of the base spans, all spans that count, n_live and n_copied."""
    scanned = scan(docs, text, owner, repository, (doc_id,))
    base = F.filter("spans", lambda s: s["kind"] < OPAQUE)
    counts = [F.size(F.filter("spans", _of_kind(i))).cast("long").alias(f"n_{k}") for i, k in enumerate(BASE)]
    own = scanned.select(F.col(f"k_{doc_id}").alias(doc_id), "uid", *counts, F.sha2(written(base), 256).alias("base_sha256"),
                         (F.size("spans") > 0).alias("any"))
    found = judged(scanned, max_owners, max_repositories).select("uid", written(F.col("spans")).alias("spans"), "n_live", "n_copied")
    none = own.where(~F.col("any")).select("*", F.lit("").alias("spans"), F.lit(0).cast("long").alias("n_live"), F.lit(0).cast("long").alias("n_copied"))
    some = own.where("any").join(found, "uid", "left").fillna({"spans": "", "n_live": 0, "n_copied": 0})
    return none.unionByName(some).drop("uid", "any")


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with every span replaced by `mark`; spans that touch or overlap are replaced as one. Spans are sorted by start."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        gap = F.substring(text, acc["at"] + 1, s["start"] - acc["at"])
        fresh = F.when((s["start"] > acc["at"]) | (F.size(acc["out"]) == 0), F.concat(acc["out"], F.array(gap, F.lit(mark)))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), fresh.alias("out"))

    done = F.aggregate(spans, start, step, lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring(text, acc["at"] + 1, F.char_length(text))))
    return F.when(F.size(spans) > 0, done).otherwise(text)


def redact(docs: DataFrame, max_owners: int = 1, max_repositories: int = 3, text: str = "text", owner: str = "source",
           repository: tuple[str, ...] = ("source", "lang"), n_chars: str | None = "n_chars") -> DataFrame:
    """`docs` with every secret that counts replaced and `n_chars` recounted where something was; a null text stays null."""
    columns = docs.columns
    scanned = scan(docs, text, owner, repository, tuple(columns), "secret-rows")
    whole = scanned.select(F.col("uid").alias("_secret_uid"), F.size("spans").alias("_secret_n"), *(F.col(f"k_{c}").alias(c) for c in columns))
    clean = whole.where("_secret_n = 0").select(*columns)
    found = judged(scanned, max_owners, max_repositories).select(F.col("uid").alias("_secret_uid"), F.col("spans").alias("_secret_spans"))
    dirty, spans = whole.where("_secret_n > 0").join(found, "_secret_uid", "left"), F.col("_secret_spans")
    dirty = dirty.withColumn(text, F.when(spans.isNotNull(), redacted(F.col(text), spans)).otherwise(F.col(text)))
    if n_chars in columns:
        dirty = dirty.withColumn(n_chars, F.when(spans.isNotNull(), F.char_length(text).cast("long")).otherwise(F.col(n_chars)))
    return clean.unionByName(dirty.select(*columns))
