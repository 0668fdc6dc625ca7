"""Benchmark decontamination by spaced seeds: masks that ignore some token positions, hash joins on the rest, overlaps verified around hits.

Tokens are runs of letters and digits of the lower-cased text. An item is found in a document where, on one alignment, `window` tokens in a
row agree but for at most `max_subs` substitutions; an item of fewer tokens is one window, with proportionally fewer. The two masks are
chosen so that every such window holds a seed hit, whatever positions are substituted (a test tries them all), so no overlap is missed. An item of
fewer than `min_tokens` tokens has no room for a mask: it is found where all its tokens stand in a row, by the hash of the whole of it.

Defined results: a null text is empty; an item without tokens never matches; repeated items or documents are matched each, equal alignments once;
an empty table on either side gives no matches; very long texts are compared whole; of further columns none is read, whatever its name.

Rows stay small at any size of document and benchmark. Documents are looked at in overlapping pieces of tokens; a seed carries numbers only, so its
alignments are told apart before a token of them is compared, and each is verified once, on the one piece of its document that holds it. Items of
equal tokens are one text: ids are joined to what was found.

A benchmark whose seeds fit `broadcast_bytes` is sent to every executor and the documents are not shuffled at all; a larger one is joined by
seed hash. Both ways give the same rows.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arraytide.llm import common

# fixed values: the token positions that each mask looks at
MASKS = ((0, 1, 2, 3, 5), (0, 1, 3, 5, 6))
SPAN = max(m[-1] for m in MASKS) + 1
# tokens of a document that are looked at together
PIECE, WIDE = 2048, 1 << 16


def tokens(text: str | Column = "text") -> Column:
    return F.split(F.lower(common.text_of(text)), r"[^\p{L}\p{Nd}]+", -1)


def pieces(table: DataFrame, tok: str, size: int, halo: int) -> DataFrame:
    """The table once per `size` tokens of `tok`, which becomes those tokens and `halo` more; `at` is the place of the first.

    Very long texts are cut twice, into parts of some `WIDE` tokens and these into pieces: a cut reads its whole array.
    """
    kept = [c for c in table.columns if c != tok]

    def cut(t: DataFrame, step: int, n: Column, at: Column) -> DataFrame:
        parts = F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)), F.lit(step)),
                            lambda c: F.struct((at + c).alias("_at"), F.slice(tok, c + 1, step + halo).alias("_tok")))
        whole = F.array(F.struct(at.alias("_at"), F.col(tok).alias("_tok")))
        return t.select(*kept, F.inline(F.when(F.size(tok) <= step, whole).otherwise(parts))).withColumnsRenamed({"_at": "at", "_tok": tok})

    wide = max(WIDE // size, 1) * size
    first = cut(table, wide, F.size(tok), F.lit(0))
    return cut(first, size, F.least(F.size(tok), F.lit(wide)), F.col("at"))


def seeds(table: DataFrame, tok: str, start: str = "j", masks: dict[int, tuple[int, ...]] | None = None) -> DataFrame:
    """The table once per place and mask, with the place as `start` and the seed hash as `h`. Places past the end look at nothing.

    A mask's number is part of its hashes, so only seeds of one mask meet.
    """
    masks = dict(enumerate(MASKS)) if masks is None else masks

    def places(k: int, mask: tuple[int, ...]) -> Column:
        n = F.size(tok) - mask[-1]
        at = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(at, lambda i: F.struct(i.alias(start), F.xxhash64(F.lit(k), *(F.get(tok, i + p) for p in mask)).alias("h")))

    # one generator for all places and masks: the tokens are not copied to every place
    return table.select("*", F.inline(F.concat(*(places(k, m) for k, m in masks.items()))))


def _verified(window: int, max_subs: int, min_tokens: int) -> Column:
    """array of first positions (in the document) of the good windows of the piece `tok`, cut at `at`, against `item_tok` on the alignment `shift`."""
    own = F.col("shift") - F.col("at")
    lo, hi = F.greatest(F.lit(0), -own), F.least(F.size("item_tok"), F.size("tok") - own)
    n = F.greatest(hi - lo, F.lit(0))
    same = F.zip_with(F.slice("tok", lo + own + 1, n), F.slice("item_tok", lo + 1, n), lambda a, b: F.when(a == b, 0).otherwise(1))
    w = F.least(F.lit(window), F.size("item_tok"))
    subs = (F.when(F.size("item_tok") >= window, F.lit(max_subs)).when(F.size("item_tok") < min_tokens, F.lit(0))
            .otherwise(F.floor(F.size("item_tok") * max_subs / window)))
    good = F.filter(F.sequence(F.lit(0), n - w), lambda k: F.size(F.filter(F.slice(same, k + 1, w), lambda x: x == 1)) <= subs)
    return F.when(n >= w, F.transform(good, lambda k: k + lo + F.col("shift"))).otherwise(F.array().cast("array<int>"))


def matches(docs: DataFrame, benchmark: DataFrame, window: int = 13, max_subs: int = 2, min_tokens: int = 8, doc_id: str = "doc_id",
            text: str = "text", item_id: str = "item_id", item_text: str = "text", broadcast_bytes: int = 16 << 20, piece: int = PIECE) -> DataFrame:
    """doc_id, item_id, shift, n_windows, first_token, last_token: one row per document, item and alignment that holds a good window."""
    items = benchmark.select(F.col(item_id).alias("item_id"), F.array_remove(tokens(item_text), "").alias("item_tok"))
    items = items.where(F.size("item_tok") > 0).distinct().withColumn("item", F.xxhash64("item_tok"))
    items = common.stored(items, "benchmark-items")
    names = items.select("item", "item_id").distinct()
    items = common.stored(items.select("item", "item_tok").distinct(), "benchmark-texts")
    held = items.agg(F.sum(F.size("item_tok") * len(MASKS) * 40 + F.octet_length(F.array_join("item_tok", " "))).alias("n"),
                     F.max(F.size("item_tok")).alias("longest")).first()
    small, longest = (held["n"] or 0) <= broadcast_bytes, held["longest"] or 1
    short = F.size("item_tok") < min_tokens
    # the lengths of short items: fewer than `min_tokens` numbers
    lengths = sorted(r[0] for r in items.where(short).select(F.size("item_tok")).distinct().collect())
    whole = {-n: tuple(range(n)) for n in lengths}
    keys = seeds(items.where(~short), "item_tok", "j").select("h", "item", "j")
    for k, mask in whole.items():
        keys = keys.unionByName(seeds(items.where(F.size("item_tok") == len(mask)), "item_tok", "j", {k: mask}).select("h", "item", "j"))
    masks = dict(enumerate(MASKS)) | whole
    sent = F.broadcast if small else lambda t: t

    # a document, with or without an id of its own, is known by the hash of its id and text until its tokens are compared
    marked = docs.select(F.col(doc_id).alias("doc_id"), common.text_of(text).alias("_text")).withColumn("mark", F.xxhash64("doc_id", "_text"))
    look = seeds(pieces(marked.select("mark", tokens("_text").alias("tok")), "tok", piece, max(m[-1] for m in masks.values())), "tok", "i", masks)
    found = look.select("mark", (F.col("at") + F.col("i")).alias("i"), "h").join(sent(keys), "h").select("mark", "item", (F.col("i") - F.col("j")).alias("shift")).distinct()
    found, n = common.counted(found, "benchmark-alignments")
    hit = found.select("mark").distinct()

    # an alignment reaches at most the longest item behind the piece that it begins in
    step = max(piece, longest)
    own = marked.join(F.broadcast(hit) if n * 32 <= broadcast_bytes else hit, "mark", "left_semi")
    cut = pieces(own.select("mark", "doc_id", tokens("_text").alias("tok")), "tok", step, longest)
    begun = found.withColumn("at", (F.floor(F.greatest("shift", F.lit(0)) / step) * step).cast("int"))
    good = cut.join(begun, ["mark", "at"]).join(sent(items), "item").select(
        "doc_id", "item", "shift", _verified(window, max_subs, min_tokens).alias("good"), F.least(F.lit(window), F.size("item_tok")).alias("width"))
    good = good.where(F.size("good") > 0).select("doc_id", "item", "shift", F.size("good").alias("n"), F.get("good", F.lit(0)).alias("first"),
                                                 (F.element_at("good", -1) + F.col("width") - 1).alias("last"))
    return good.join(names, "item").groupBy("doc_id", "item_id", "shift").agg(
        F.max("n").alias("n_windows"), F.min("first").alias("first_token"), F.max("last").alias("last_token"))


def contaminated(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """doc_id, item_id, n_windows: the contaminated documents with each item that they hold."""
    return matches(docs, benchmark, **how).groupBy("doc_id", "item_id").agg(F.sum("n_windows").alias("n_windows"))


def without_leaks(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """`docs` without the contaminated ones; rows are judged by their own text, whatever their ids."""
    t = docs.withColumn("_leak_mark", F.xxhash64(common.text_of(text)))
    bad = matches(t, benchmark, doc_id="_leak_mark", text=text, **how).select(F.col("doc_id").alias("_leak_mark")).distinct()
    return t.join(bad, "_leak_mark", "left_anti").select(*docs.columns)
