"""Resampling, license scans and the divergence audit against brute force, with nulls, long texts, ties, repeated rows, clashing columns, empty tables."""
import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from arraytide.llm import divergence, licenses, resampling

CLASHING = ["bucket", "n", "weight", "score", "rank", "place", "range", "term", "segment", "number", "value", "uid", "found", "line", "held", "level", "rule", "n_words", "item"]


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def prose(rng, n, vocabulary):
    return " ".join(rng.choice(vocabulary) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    """doc_id, text, lang, source with every edge case."""
    rng = random.Random(11)
    vocabulary = ["w" + chr(97 + i) + chr(97 + i * i % 26) for i in range(25)] + ["Éa", "x9", "UP", "数据"]
    out = [(i, prose(rng, rng.choice([5, 25, 80]), vocabulary), rng.choice(["en", "de"]), rng.choice(["a", "b", "c", "é"])) for i in range(70)]
    out += [(100 + i, prose(rng, 30, vocabulary[:3]), "en", "hot") for i in range(50)]
    out += [(200, None, None, None), (201, "", "en", None), (None, prose(rng, 40, vocabulary), "en", "a"), (202, prose(rng, 40_000, vocabulary), "de", "long"),
            (203, "a b" * 11 + "\n\t.-" + "C" * 5000, "zz", "1"), (204, "one Two", "zz", "2")]
    return out + [out[3], out[3], out[60]]


@pytest.fixture(scope="module")
def docs(spark, rows):
    t = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3)
    return t.select("*", *(F.lit("7").alias(c) for c in CLASHING))


# ---- resampling

def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def drawn_by_force(rows, target, most, buckets=10_000, percent=10, least=20):
    def bag(text):
        w = words(text)
        return collections.Counter(zlib.crc32(" ".join(w[i:i + n]).encode()) % buckets for n in range(1, most + 1) for i in range(len(w) - n + 1))

    s, t = sum((bag(r[1]) for r in rows), collections.Counter()), sum((bag(x) for x in target), collections.Counter())
    big_s, big_t = s.total(), t.total()
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (big_s + buckets) / ((s[b] + 1) * (big_t + buckets)))) for b in s}
    out = []
    for r in rows:
        own = bag(r[1])
        weight = sum(gain[b] * n for b, n in own.items()) // own.total() if own else 0
        h = int(hashlib.sha256(f"2024:{'' if r[0] is None else r[0]}".encode()).hexdigest()[:8], 16)
        out.append((r[0], own.total(), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2 ** 32))), len(words(r[1]))))
    able = sorted((x for x in out if x[4] >= least), key=lambda x: (-x[3], x[0] is not None, x[0] or 0))
    ranks = collections.defaultdict(list)
    for k, x in enumerate(able[: len(able) * percent // 100]):
        ranks[x].append(k + 1)
    return collections.Counter((*x[:4], ranks[x].pop(0) if ranks[x] else None) for x in out)


@pytest.mark.parametrize("most,percent", [(1, 10), (2, 100)])
def test_resample_equals_brute_force(spark, docs, rows, most, percent):
    target = ["wa wb wa x9 数据 unseen", None, "UP up wz"]
    t = spark.createDataFrame([(x,) for x in target], "text string")
    got = resampling.resample(docs, t, most=most, percent=percent)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert collections.Counter(map(tuple, got.collect())) == drawn_by_force(rows, target, most, percent=percent)


def test_resample_of_empty_tables(spark, docs, rows):
    none = docs.where("false")
    assert resampling.resample(none, docs).count() == 0
    assert collections.Counter(map(tuple, resampling.resample(docs, none).collect())) == drawn_by_force(rows, [], 1)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(-40_000, 40_000), min_size=70, max_size=70), st.lists(st.tuples(st.integers(0, 4), st.integers(0, 69), st.integers(1, 600)), max_size=40))
def test_bit_sliced_sums_are_plain_sums(gain, bags):
    gain = np.array(gain, np.int64)
    row = np.repeat(np.array([b[0] for b in bags], np.int64), [b[2] for b in bags])
    bucket = np.repeat(np.array([b[1] for b in bags], np.int64), [b[2] for b in bags])
    got = resampling.sums(bucket, row, 5, resampling.gain_planes(gain), 70)
    assert got.tolist() == [int(gain[bucket[row == r]].sum()) for r in range(5)]


# ---- licenses

LICENSED = [
    "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3.", "Licensed under CC BY-NC 4.0.", "cc-by-nc cc by nc (CC BY NC)",
    "SPDX-License-Identifier: Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
    "GPL gpl GPLv2 LGPL-2.1 and the GNU Lesser General Public License v3", "nothing here", "", None, "under the mit", "xunder the mit license under the mit licensey",
    "Copyright (c) 2020 Some One. All rights reserved.", "public domain; dedicated to the public domain", "Kelvin K under the Kit license", "BSD 3-Clause license, BSD-style",
    "see the LICENSE file for details", "https://creativecommons.org/licenses/by-nc-sa/4.0/ and CC0", " ".join(["under the mit license"] * 3000), "x " * 30_000 + "gplv3",
]


def licenses_by_force(text):
    line = f" {' '.join(words(text))} "
    found = []
    for i, (label, level, _, regex, base) in enumerate(licenses.RULES):
        for m in re.finditer(rf"(?<= )(?:{regex})(?= )", line, re.A):
            first = line[: m.start()].count(" ") - 1
            found.append((first, first + m[0].count(" ") + 1, level, i, label, base))
    keep = [d for d in found if not any(o[0] <= d[0] and o[1] >= d[1] and o[2] <= d[2] and o[:4] != d[:4] and (o[:2] != d[:2] or o[2:4] < d[2:4]) for o in found)] if len(found) < 500 else None
    base = sorted({d[4] for d in found if d[5]})
    starts = [d[0] for d in found if d[5]]
    if keep is None:
        return len(words(text)), len(starts), min(starts), max(starts), ",".join(base)
    return (len(words(text)), len(starts), min(starts, default=None), max(starts, default=None), ",".join(base), ",".join(sorted(set(base) | {d[4] for d in keep})),
            max((licenses.CONFIDENCE[d[2]] for d in keep), default=0.0))


def test_license_report_equals_brute_force(spark):
    rows = [(i, t) for i, t in enumerate(LICENSED)] + [(0, LICENSED[0]), (None, LICENSED[4])]
    t = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).select("*", *(F.lit("7").alias(c) for c in CLASHING))
    got = licenses.report(t)
    assert got.columns == ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    got = sorted((tuple(r) for r in got.collect()), key=str)
    want = sorted(((i, *licenses_by_force(x)) for i, x in rows), key=str)
    assert len(got) == len(want)
    for g, w in zip(got, want, strict=True):
        assert g[: len(w)] == w
    labels = {r[0]: r[6] for r in got}
    assert labels[0] == "mit" and labels[1] == "gpl-3" and labels[2] == "cc-by-nc" and labels[4] == "apache-2" and labels[18] == "mit" and labels[19] == "gpl-3"
    assert licenses.report(t.where("false")).count() == 0


def holds(regex, keyword):
    @settings(max_examples=8, database=None, derandomize=True, deadline=None)
    @given(st.from_regex(re.compile(f"(?:{regex})".replace("[^ ]", "[a-z]"), re.A), fullmatch=True))
    def check(x):
        assert f" {keyword} " in f" {x} "
    check()


def test_license_rules_are_hundreds_and_hold_their_keywords():
    assert len(licenses.RULES) > 200
    for _, level, keyword, regex, _ in licenses.RULES:
        assert 0 <= level < len(licenses.CONFIDENCE)
        holds(regex, keyword)


# ---- divergence

def audit_by_force(rows, min_docs, top=50, scale=1_000_000_000, smooth=5):
    own, df, langs, groups = collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter), set()
    for _, text, lang, source in rows:
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")
        terms, lang = [lower(t) for t in terms], lang or ""
        groups.add((lang, source or ""))
        own[lang, source or ""].update(terms)
        langs[lang].update(terms)
        df[lang].update(set(terms))
    out = []
    for lang, source in groups:
        kept = [t for t in df[lang] if df[lang][t] >= min_docs]

        def p(counts, kept=kept):
            n = sum(counts[t] for t in kept) + smooth * len(kept)
            return {t: 1 + scale * (counts[t] + smooth) // n for t in kept}

        mine, whole = p(own[lang, source]), p(langs[lang])
        pairs = []
        for other in (s for g, s in groups if g == lang and s != source):
            q = p(own[lang, other])
            pairs.append((other, sum(abs(mine[t] - q[t]) for t in kept)))
        terms = [(t, mine[t] - whole[t]) for t in kept if own[lang, source][t] and mine[t] > whole[t]]
        for part, found, most in (("pair", pairs, None), ("term", terms, top)):
            found.sort(key=lambda x: (-x[1], x[0].encode()))
            out += [(lang, source, part, item, value, k + 1) for k, (item, value) in enumerate(found[:most])]
    return collections.Counter(out)


@pytest.mark.parametrize("min_docs,leaves,block,scale", [(1, 4, 2, 1_000_000_000), (20, 4096, 64, 1_000_000_000), (3, 8, 1, 3 * 10 ** 11), (10 ** 6, 4, 2, 1000)])
def test_audit_equals_brute_force(docs, rows, min_docs, leaves, block, scale):
    got = divergence.audit(docs, min_docs=min_docs, top=7, scale=scale, leaves=leaves, block=block)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert collections.Counter(map(tuple, got.collect())) == audit_by_force(rows, min_docs, 7, scale)


def test_audit_of_an_empty_table(docs):
    assert divergence.audit(docs.where("false")).count() == 0


def test_trees_share_equal_subtrees_and_price_them_once():
    rng = np.random.default_rng(3)
    counts = np.zeros((3, 1000), np.int64)
    counts[0, :50] = rng.integers(1, 9, 50)
    counts[1], counts[2, 900:910] = counts[0], 4
    leaves, levels, root = divergence.forest(counts)
    assert root[0] == root[1] != root[2]
    # ten levels over 1,024 places, and far fewer nodes than places
    assert len(levels) == 10 and sum(len(a) for a, _ in levels) < 200
    got = divergence.prices(levels, leaves, root[0], root[[1, 2]], 300, np.array([300, 40]), 1000, 10 ** 9, 5)
    p, q = ((1 + 10 ** 9 * (c + 5) // (n + 5000)) for c, n in ((counts[0], 300), (counts[2], 40)))
    assert got.tolist() == [0, int(np.abs(p - q).sum())]
    big = np.array([[10 ** 11, 0, 7]], np.int64)
    assert divergence.shares(big[0], np.array(10 ** 12), 3, 10 ** 9, 5).tolist() == [1 + 10 ** 9 * (int(c) + 5) // (10 ** 12 + 15) for c in big[0]]
