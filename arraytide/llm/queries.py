"""The registered queries of the corpus operators and, where DuckDB can say the same, their statements."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arraytide.llm import (common, decontaminate, divergence, jaccard, lattice, licenses, lm, orc_tokens, packing, quality, radix, resampling, secrets,
                           warc)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f
    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("""
    WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
    d AS (SELECT page_id, octet_length(body) AS payload_bytes, sha1(body) AS payload_digest FROM p),
    k AS (SELECT payload_digest, max(page_id) AS keeper FROM d WHERE payload_bytes >= 1000 GROUP BY 1)
    SELECT page_id, payload_bytes, d.payload_digest,
           CASE WHEN keeper IS NOT NULL AND page_id IS DISTINCT FROM keeper THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN keeper IS NOT NULL AND page_id IS DISTINCT FROM keeper THEN keeper END AS refers_to
    FROM d LEFT JOIN k USING (payload_digest)""")
def op1_warc_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write `pages` as WARC transactions, read the archives back, assemble captures, report each page."""
    roles = warc.with_roles(table(spark, sf_dir, "pages"))
    manifest = warc.write(roles, common.shared_path(spark, "warc"))
    return warc.resolve(warc.assemble(warc.read(manifest, with_payload=False)))


@query()
def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that hold a benchmark passage, with its item."""
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query()
def op3_radix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bytes of every document that repeat 50-byte strings of documents with smaller ids."""
    return radix.remove_repeats(table(spark, sf_dir, "documents")).drop("span_start", "span_end")


@query()
def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents: 4-word shingles, Jaccard 0.85."""
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


def tokenizer(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@query()
def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as sequences of 2048 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


def graded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").select("doc_id", quality.grade_of().alias("grade"))


@query()
def op6_quality_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that the ordinal classifier selects, with their expected grade and tail probabilities."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    picked = quality.selected(docs, graded(spark, sf_dir))
    return picked.select("doc_id", "expected_grade", F.get("tails", F.lit(0)).alias("p_not_toxic"), F.element_at("tails", -1).alias("p_good"))


@query()
def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-probabilities of all documents under the automaton learned from four fifths of them."""
    return lm.score(table(spark, sf_dir, "documents"))


@query("""
    WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e, row_number() OVER () AS r FROM embeddings
                         WHERE label IS NOT NULL AND embedding IS NOT NULL),
    l AS (SELECT a.vec_id AS u, b.vec_id AS v FROM v a JOIN v b ON a.label = b.label AND a.r <> b.r
          WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
    reach(u, v) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT reach.u, l.v FROM reach JOIN l ON reach.v = l.u),
    n AS (SELECT u, count(*) AS n_links FROM l GROUP BY u),
    c AS (SELECT u, min(v) AS component_id FROM reach GROUP BY u)
    SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
    FROM embeddings JOIN c ON vec_id = c.u LEFT JOIN n ON vec_id = n.u""")
def op8_lattice_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings."""
    return lattice.near_duplicates(table(spark, sf_dir, "embeddings"))


@query()
def op9_orc_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the token ids of all documents as ORC, read them back, report where each document's ids are."""
    path = common.shared_path(spark, "token-ids")
    orc_tokens.write(table(spark, sf_dir, "documents"), path, tokenizer("word_bpe_49k.json"))
    return orc_tokens.index(orc_tokens.read(spark, path))


@query()
def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document; the source owns its documents and keeps one repository per language."""
    return secrets.report(table(spark, sf_dir, "documents"))


# the words of a text after A-Z became a-z, as DuckDB takes them
_LOWER = "translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = f"regexp_extract_all({_LOWER.format('text')}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


@query(f"""
    WITH RECURSIVE d AS (SELECT doc_id, row_number() OVER () AS r, {_WORDS} AS w FROM documents),
    dw AS MATERIALIZED (SELECT r, w, count(*) AS n FROM (SELECT r, unnest(w) AS w FROM d) GROUP BY ALL),
    bw AS MATERIALIZED (SELECT w, count(*) AS n FROM (SELECT unnest({_WORDS}) AS w FROM benchmark) GROUP BY ALL),
    tab(i, c, k) AS (SELECT range, range, 0 FROM range(256) UNION ALL
                     SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM tab WHERE k < 8),
    crc AS (SELECT list(c ORDER BY i) AS t FROM tab WHERE k = 8),
    vocab AS (SELECT DISTINCT w FROM (SELECT w FROM dw UNION ALL SELECT w FROM bw)),
    b AS MATERIALIZED (SELECT w, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(octet_length(encode(w))), lambda i: ('0x' || hex(encode(w))[2 * i + 1: 2 * i + 2])::BIGINT)),
                                        lambda a, x: xor(a >> 8, t[xor(a & 255, x) + 1])), 4294967295) % 10000 AS bucket FROM vocab, crc),
    s AS (SELECT bucket, sum(n)::BIGINT AS s FROM dw JOIN b USING (w) GROUP BY 1),
    t AS (SELECT bucket, sum(n)::BIGINT AS t FROM bw JOIN b USING (w) GROUP BY 1),
    z AS (SELECT (SELECT coalesce(sum(s), 0) FROM s)::DOUBLE AS s_all, (SELECT coalesce(sum(t), 0) FROM t)::DOUBLE AS t_all),
    g AS (SELECT s.bucket, floor(1000 * ln((coalesce(t, 0)::DOUBLE + 1) * (s_all + 10000) / ((s.s::DOUBLE + 1) * (t_all + 10000))))::BIGINT AS gain FROM s LEFT JOIN t USING (bucket), z),
    m AS (SELECT r, sum(n * gain)::BIGINT AS total, sum(n)::BIGINT AS n FROM dw JOIN b USING (w) JOIN g USING (bucket) GROUP BY 1),
    h AS (SELECT doc_id, coalesce(n, 0) AS n_features, coalesce((total - ((total % n) + n) % n) // n, 0) AS weight,
                 ('0x' || sha256('2024:' || doc_id)[1:8])::BIGINT AS h FROM d LEFT JOIN m USING (r)),
    x AS (SELECT doc_id, n_features, weight, weight + floor(-1000 * ln(-ln((h + 0.5) / 4294967296)))::BIGINT AS score FROM h),
    k AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS rk FROM x)
    SELECT doc_id, n_features, weight, score,
           CASE WHEN n_features >= 20 AND rk <= (SELECT 10 * count(*) // 100 FROM x WHERE n_features >= 20) THEN rk END AS rank FROM k""")
def op11_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents drawn towards the word distribution of the benchmark."""
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _license_values() -> str:
    """The rule table as DuckDB rows; words stand between two spaces there, so that neighbouring matches share none."""
    rows = []
    for i, (label, level, keyword, regex, base) in enumerate(licenses.RULES):
        wide = " (" + regex.replace("[^ ]", "[^~]").replace(" ", "  ").replace("[^~]", "[^ ]") + ") "
        rows.append(f"({i}, '{label}', {level}, {licenses.CONFIDENCE[level]}::DOUBLE, '{keyword}', '{wide}', {str(base).lower()})")
    return ", ".join(rows)


@query(f"""
    WITH rules(rule, label, level, confidence, keyword, regex, base) AS (VALUES {_license_values()}),
    d AS MATERIALIZED (SELECT doc_id, row_number() OVER () AS r, {_WORDS} AS w FROM documents),
    line AS MATERIALIZED (SELECT r, ' ' || array_to_string(w, '  ') || ' ' AS line FROM d WHERE len(w) > 0),
    marked AS (SELECT r, rule, string_split(regexp_replace(line, regex, ' ' || chr(1) || '\\1' || chr(2) || ' ', 'g'), '  ') AS w
               FROM line JOIN rules ON contains(line, ' ' || keyword || ' ') AND regexp_matches(line, regex)),
    clean AS (SELECT r, rule, list_transform(w, lambda x: trim(x, ' ')) AS w FROM marked),
    ends AS (SELECT r, rule, list_filter(range(len(w)), lambda i: w[i + 1][1] = chr(1)) AS a, list_filter(range(len(w)), lambda i: w[i + 1][-1] = chr(2)) AS b FROM clean),
    hits AS MATERIALIZED (SELECT r, rule, unnest(a) AS first, unnest(b) + 1 AS last FROM ends),
    h AS MATERIALIZED (SELECT r, first, last, rule, label, level, confidence, base FROM hits JOIN rules USING (rule)),
    kept AS (SELECT * FROM h WHERE NOT EXISTS (SELECT 1 FROM h AS o WHERE o.r = h.r AND o.first <= h.first AND o.last >= h.last AND o.level <= h.level
                 AND (o.first < h.first OR o.last > h.last OR o.level < h.level OR o.rule < h.rule))),
    based AS (SELECT r, count(*) AS n_base, min(first) AS first_word, max(first) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM h WHERE base GROUP BY 1),
    labelled AS (SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(score) AS score
                 FROM (SELECT r, label, confidence AS score FROM kept UNION ALL SELECT r, label, 0 FROM h WHERE base) GROUP BY 1)
    SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels,
           coalesce(labels, '') AS labels, coalesce(score, 0)::DOUBLE AS score
    FROM d LEFT JOIN based USING (r) LEFT JOIN labelled USING (r)""")
def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License labels of every document."""
    return licenses.report(table(spark, sf_dir, "documents"))


@query(f"""
    WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                                   regexp_extract_all({_LOWER.format('text')}, '[^\\x00-\\x60\\x7B-\\x7F]+') AS w FROM documents),
    x AS MATERIALIZED (SELECT lang, source, w AS term, count(*) AS n, count(DISTINCT r) AS df FROM (SELECT r, lang, source, unnest(w) AS w FROM d) GROUP BY ALL),
    kept AS MATERIALIZED (SELECT lang, term, sum(n)::HUGEINT AS n FROM x GROUP BY ALL HAVING sum(df) >= 30),
    l AS (SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS total FROM kept GROUP BY 1),
    own AS (SELECT x.lang, source, term, x.n::HUGEINT AS n FROM x JOIN kept USING (lang, term)),
    g AS (SELECT lang, source, coalesce(total, 0)::HUGEINT AS total FROM (SELECT DISTINCT lang, source FROM d)
          LEFT JOIN (SELECT lang, source, sum(n) AS total FROM own GROUP BY ALL) USING (lang, source)),
    p AS MATERIALIZED (SELECT g.lang, g.source, kept.term, coalesce(own.n, 0) AS n, 1 + 1000000000 * (coalesce(own.n, 0) + 5) // (g.total + 5 * v) AS p,
                              1 + 1000000000 * (kept.n + 5) // (l.total + 5 * v) AS q
                       FROM g JOIN kept ON g.lang = kept.lang JOIN l ON l.lang = g.lang LEFT JOIN own ON own.lang = g.lang AND own.source = g.source AND own.term = kept.term),
    pairs AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p AS a JOIN p AS b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
    rows_ AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
              FROM g AS a JOIN g AS b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
              UNION ALL SELECT lang, source, 'term', term, (p - q)::BIGINT FROM p WHERE n > 0 AND p > q),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS k FROM rows_)
    SELECT lang, source, part, item, value, k::INTEGER AS rank FROM ranked WHERE part = 'pair' OR k <= 50""")
def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Differences between the sources of each language, and the terms that a source overuses."""
    return divergence.audit(table(spark, sf_dir, "documents"))
