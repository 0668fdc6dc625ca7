"""The corpus pipeline against a brute-force version of its stages, and its contract."""
import collections
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from test_operators import WORD, base_spans, lower, prose

import corpus_pipeline

tokenizer_files = pytest.importorskip("public_tokenizers")
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(11)
    root = tmp_path_factory.mktemp("corpus")
    items = [(i, prose(rng, 25)) for i in range(4)]
    rows, labels = [], []
    for i in range(500):
        w = prose(rng, 60).split()
        kind = i % 5
        if kind == 0:
            w[7] = rng.choice(["trash", "idiot", "scum"])
        if kind == 1:
            w = [x + "###" for x in w]
        if i % 7 == 3:
            w[20:20] = items[i % 4][1].split()
        if i % 11 == 4:
            w[30] = "password=" + "".join(rng.choice("abcXYZ019") for _ in range(16))
        rows.append((i, " ".join(w)))
        labels.append((i, 0 if kind == 1 else 1, 1 if kind == 0 else 0))
    near = rows[2][1].split()
    for k in range(6):
        near[rng.randrange(len(near))] = f"changed{k}"
        rows.append((600 + k, " ".join(near)))
    rows += [(700, None), (701, ""), (702, rows[4][1]), rows[8], rows[8], (703, prose(rng, 5000))]
    t = spark.createDataFrame([(i, x, "en", f"s{(i or 0) % 3}", len(x or "")) for i, x in rows], COLUMNS)
    t.repartition(3).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    return str(root)


def near_duplicates_gone(rows):
    sets = {}
    for i, t in rows:
        w = WORD.findall(lower(t))
        sets[i] = frozenset(zip(*(w[k:] for k in range(5)), strict=False)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        n = len(sets[a] & sets[b])
        if n and 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: t for i, t in rows if find(i) == i}


def leaks(text, items):
    a = re.findall(r"[a-z0-9]+", lower(text))
    return any(sum(x != y for x, y in zip(a[i:i + 13], b[j:j + 13], strict=True)) <= 2
               for b in items for i in range(len(a) - 12) for j in range(len(b) - 12))


def test_pipeline_equals_brute_force(spark, folder):
    from tokenizers import Tokenizer
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    chosen = corpus_pipeline.select_quality(spark, docs, folder)
    assert chosen.columns == docs.columns
    kept = [(r["doc_id"], r["text"]) for r in chosen.collect()]
    ids = {i for i, _ in kept}
    clean = [i for i in range(500) if i % 5 > 1]
    assert sum(i in ids for i in clean) > 0.97 * len(clean) and sum(i in ids for i in range(500) if i % 5 < 2) < 0.2 * 200
    items = [re.findall(r"[a-z0-9]+", lower(r["text"])) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    left = {i: t for i, t in near_duplicates_gone(kept).items() if not leaks(t, items)}
    assert len(left) < len(ids)
    tok = Tokenizer.from_file(tokenizer_files.path("byte_bpe_50k.json"))
    want = collections.Counter()
    for i, t in left.items():
        merged = []
        for a, _, b in base_spans(t or ""):
            if merged and a <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], b)
            else:
                merged.append([a, b])
        for a, b in reversed(merged):
            t = t[:a] + "[SECRET]" + t[b:]
        x = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        first = (len(x) - 1) % 2048 + 1
        edges = [0, *range(first, len(x) + 1, 2048)]
        want.update((i, k, a, b - a, zlib.crc32(x[a:b].tobytes())) for k, (a, b) in enumerate(itertools.pairwise(edges)))
    got = corpus_pipeline.run(spark, folder).collect()
    assert collections.Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    filled = collections.Counter()
    for r in got:
        filled[r["sequence_id"]] += r["length"]
    assert max(filled.values()) <= 2048 and len(filled) <= -(-sum(filled.values()) // 2048) * 1.1 + 1


def test_stages_keep_columns_and_take_empty_tables(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "ngram_jaccard_join", "benchmark_decontamination", "secret_scans", "best_fit_packing"]
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), folder).count() == 0
    for _, stage in corpus_pipeline.STAGES[1:4]:
        assert stage(spark, docs.where("doc_id < 20"), folder).columns == docs.columns
