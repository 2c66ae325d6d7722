"""Corpus operators against brute force, and on nulls, blanks, ties, repeats and empty tables."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tokenizers
import xxhash
from pyspark.sql import functions as F

from churnline.llm import context_tree, decontamination, licenses, packing, quality, sharding, simhash, tokens, toxicity, url_filters
from churnline.llm.common import components

SCHEMA = "doc_id long, text string, lang string, source string, score double, shard int, row long"
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def texts(n=60, seed=3):
    source = random.Random(seed)
    words = ["alpha", "Beta", "gamma.", "delta", "über", "eins,", "zwei", "cc", "by", "all rights reserved", "x1"]
    made = [" ".join(source.choice(words) for _ in range(source.randint(1, 80))) for _ in range(n)]
    long = "\n".join(" ".join(source.choice(words) for _ in range(40)) for _ in range(150))
    return [None, "", " \n\t", "word", "日本語 ☃", "GNU General Public License", made[0], made[0], made[0] + " tail", long, *made]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en" if i % 3 else None, "s", 0.5, 7, 1) for i, t in enumerate(texts())]
    rows += [rows[-1], (None, "text without id", "de", None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def given(docs):
    return [(r.doc_id, r.text) for r in docs.collect()]


def test_minimax_capacity_is_the_smallest(spark):
    source = random.Random(5)
    for shards in (1, 3, 7):
        sizes = [source.randint(1, 50) for _ in range(60)] + [400]
        rows = [(source.getrandbits(64) - (1 << 63), s) for s in sizes]
        cuts, capacity = sharding.plan_cuts(spark.createDataFrame(rows, "key long, bytes long"), shards)
        ordered = [s for _, s in sorted(rows)]

        def fits(most):
            used, room = 1, most
            for s in ordered:
                if s > most:
                    return False
                if s > room:
                    used, room = used + 1, most
                room -= s
            return used <= shards

        assert fits(capacity) and not fits(capacity - 1)
        held = Counter()
        for key, s in rows:
            held[sum(c is not None and key >= c for c in cuts)] += s
        assert max(held.values()) <= capacity and max(held) < shards


def test_shards_keep_equal_texts_together_and_number_rows(docs, empty):
    rows = sharding.with_slots(sharding.with_shards(docs.drop("shard", "row"), 5)).collect()
    assert len(rows) == docs.count()
    of_text, slots = defaultdict(set), defaultdict(list)
    for r in rows:
        of_text[r.text].add(r.shard)
        slots[r.shard].append(r.slot)
    assert all(len(s) == 1 for s in of_text.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.with_shards(empty.drop("shard"), 5).count() == 0
    clashing = docs.withColumns({"slot": F.lit("s"), "shift": F.lit(1), "n": F.lit(2), "first": F.lit(3)})
    named = sharding.with_slots(sharding.with_shards(clashing, 5), shard="shard_")
    assert named.columns == [*clashing.columns, "shard_", "slot_"]
    assert {r.shard for r in named.collect()} == {7, None} and Counter(r.shard_ for r in named.collect()) == Counter(r.shard for r in rows)


@pytest.mark.parametrize(("hot", "bucket"), [(context_tree.HOT_STRINGS, context_tree.BUCKET_STRINGS), (3, 4)])
def test_context_tree_equals_a_recursive_one(spark, monkeypatch, hot, bucket):
    # The second case joins nearly all strings, from many buckets.
    monkeypatch.setattr(context_tree, "HOT_STRINGS", hot)
    monkeypatch.setattr(context_tree, "BUCKET_STRINGS", bucket)
    train = [b"abab", b"abba\xc3\xa4", b""]
    depth, seen = 2, defaultdict(lambda: [0, 0])
    for t in train:
        padded = context_tree.END * depth + t + context_tree.END
        for i in range(depth, len(padded)):
            for k in range(8):
                decided = (1 << k) | (padded[i] >> (8 - k))
                for d in range(depth + 1):
                    seen[(padded[i - d : i], decided)][(padded[i] >> (7 - k)) & 1] += 1
    kt = lambda a, b: math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)
    children = defaultdict(list)
    for c, p in seen:
        if c:
            children[(c[1:], p)].append((c, p))

    def weighted(node):
        own = kt(*seen[node])
        return own if len(node[0]) == depth else math.log(0.5 * math.exp(own) + 0.5 * math.exp(sum(map(weighted, children[node]))))

    def one(c, p, d=0):
        node = (c[len(c) - d :], p)
        zeros, ones = seen[node]
        own = (ones + 0.5) / (zeros + ones + 1)
        if d == depth or (c[len(c) - d - 1 :], p) not in seen:
            return own
        stop = 0.5 * math.exp(kt(zeros, ones)) / math.exp(weighted(node))
        return stop * own + (1 - stop) * one(c, p, d + 1)

    def log10(t):
        padded, total = context_tree.END * depth + t + context_tree.END, 0.0
        for i in range(depth, len(padded)):
            for k in range(8):
                decided, bit = (1 << k) | (padded[i] >> (8 - k)), (padded[i] >> (7 - k)) & 1
                p = one(padded[i - depth : i], decided) if (b"", decided) in seen else 0.5
                total += math.log10(p if bit else 1 - p)
        return total

    asked = [b"ab", b"", b"zz", b"abab", "ä".encode()]
    rows = [(i, t.decode(), True) for i, t in enumerate(train)] + [(10 + i, t.decode(), False) for i, t in enumerate(asked)]
    table = spark.createDataFrame(rows, "doc_id long, text string, learn boolean")
    got = {r.doc_id: r.score for r in context_tree.score(table, F.col("learn"), depth).collect()}
    for i, t in enumerate(asked):
        assert got[10 + i] == pytest.approx(log10(t), abs=1e-8)


def test_base_scores(docs, empty):
    got = {r.doc_id: r for r in context_tree.score(docs, F.coalesce(F.col("doc_id") % 4 != 0, F.lit(True)), 2).collect()}
    split = [(i, (t or "").translate(UPPER).encode().split() + [b"\n"]) for i, t in given(docs)]
    counts = Counter(w for i, ws in split if i is None or i % 4 for w in ws)
    total = sum(counts.values())
    for i, ws in split:
        assert (got[i].n_tokens, got[i].n_known, got[i].train_tokens) == (len(ws), sum(counts[w] > 0 for w in ws), total)
        assert got[i].base_score == pytest.approx(sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (len(counts) + 1))) for w in ws))
    assert context_tree.score(empty, F.lit(True), 2).count() == 0


def test_toxicity_learns_from_labels_and_locates(spark, empty):
    source = random.Random(1)
    rows, labels = [], []
    for i in range(900):
        sentences = [" ".join(source.choice("red blue green gold iron wood".split()) for _ in range(6)) for _ in range(8)]
        bad = source.random() < 0.3
        if bad:
            sentences[3] += source.choice([" slurrat", " slurrous", " slurrik"])
        rows.append((i, ". ".join(sentences)))
        labels.append((i, int(bad)))
    rows += [(1000, None), (1001, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marked = spark.createDataFrame([*labels, (None, 1), (3, None)], "doc_id long, toxic int")
    weights = toxicity.fitted(docs, marked)
    scores = {r.doc_id: r.s for r in docs.select("doc_id", toxicity.scorer(weights)("text").alias("s")).collect()}
    assert all((scores[i] >= 0.5) == bool(y) for i, y in labels)
    neutral = 1 / (1 + math.exp(-weights[-1]))
    assert scores[1000] == scores[1001] == pytest.approx(neutral) and neutral < 0.2
    # However long, a text without evidence scores as an empty one does.
    plain = spark.createDataFrame([("qqq zzz. " * n,) for n in (1, 100_000)], "text string")
    assert [r.s for r in plain.select(toxicity.scorer(weights)("text").alias("s")).collect()] == pytest.approx([neutral] * 2)
    blamed = toxicity.offending(docs, weights).collect()
    assert blamed and all("slurr" in r.sentence and r.number == 3 for r in blamed)
    kept = toxicity.without_toxic(docs.withColumn("score", F.lit("x")), marked)
    assert kept.columns == ["doc_id", "text", "score"] and kept.count() == 902 - sum(y for _, y in labels)
    assert toxicity.fitted(docs, marked.where("toxic = 0")) is None
    assert toxicity.without_toxic(empty, marked).count() == 0


def noisy_or(weights, rows):
    """Mean log loss of compact rows, sentence by sentence."""
    total, sigmoid = 0.0, lambda z: 1 / (1 + math.exp(-z))
    leak = sigmoid(weights[-1])
    for y, sentences, at, features in rows:
        clean = 1 - leak
        for s in range(sentences):
            u = sum(weights[f] for i, f in zip(at, features) if i == s)
            clean *= 1 - max(0.0, (sigmoid(weights[-1] + u) - leak) / (1 - leak))
        total -= y * math.log(1 - clean) + (1 - y) * math.log(clean)
    return total


def test_toxicity_gradient_equals_finite_differences(spark):
    source = random.Random(3)
    rows = []
    for _ in range(40):
        n, hits = source.randint(1, 6), source.randint(0, 8)
        rows.append((source.choice([0.0, 0.5, 1.0]), n, sorted(source.randrange(n) for _ in range(hits)), [source.randrange(5) for _ in range(hits)]))
    rows.append((1.0, 0, [], []))
    compacted = spark.createDataFrame(rows, "y double, sentences int, sentence array<int>, feature array<int>").repartition(3)
    weights = np.array([1.5, -0.7, 0.4, 2.2, 0.9, -2.0])
    got = toxicity._gradient(compacted, weights)
    for i in range(len(weights)):
        step = np.zeros_like(weights)
        step[i] = 1e-6
        assert got[i] == pytest.approx((noisy_or(weights + step, rows) - noisy_or(weights - step, rows)) / 2e-6, abs=1e-4)


def test_token_counts_equal_the_library(docs, empty):
    vocabulary = tokens.unigram_vocabulary()
    model = tokenizers.Tokenizer(tokenizers.models.Unigram(vocabulary, 0, False))
    model.pre_tokenizer = tokenizers.pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    got = docs.select("text", tokens.token_counts()("text").alias("c")).collect()
    for r in got:
        assert r.c.n_tokens == len(model.encode(r.text or "").ids)
    ties = tokens.Counter([("<unk>", 0.0), ("a", -1.0), ("aa", -2.0), ("b", -3.0)])
    assert ties.text("aaa")[1] == len(tokenizers.Tokenizer(tokenizers.models.Unigram([("<unk>", 0.0), ("a", -1.0), ("aa", -2.0), ("b", -3.0)], 0, False)).encode("aaa").ids) + 1
    assert empty.select(tokens.token_counts()("text")).count() == 0


def test_license_places(docs, empty):
    phrases = [(label, p.split()) for label, p in licenses.PHRASES]
    got = {r.doc_id: r for r in licenses.scan(docs).collect()}
    for i, t in given(docs):
        ws = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(UPPER))
        at = [(k, label) for label, p in phrases for k in range(len(ws)) if ws[k : k + len(p)] == p]
        r = got[i]
        assert (r.n_words, r.n_base, r.base_labels) == (len(ws), len(at), ",".join(sorted({x for _, x in at})))
        assert (r.first_word, r.last_word) == (min((k for k, _ in at), default=None), max((k for k, _ in at), default=None))
        assert set(r.base_labels.split(",")) <= set(r.labels.split(",")) or not r.base_labels
    assert licenses.scan(empty).count() == 0


def test_license_notice_with_words_added(spark):
    notice = "Permission is hereby granted, free of any charge, to each person obtaining a copy of this software and associated documentation files"
    r = licenses.scan(spark.createDataFrame([(1, "some words " * 30 + notice)], "doc_id long, text string")).first()
    assert r.labels == "mit" and 0.6 <= r.score < 1 and r.n_base == 0


CONFUSABLE = [
    ("Licensed under CC BY 4.0.", "cc-by"),
    ("Licensed under CC BY-SA 4.0.", "cc-by,cc-by-sa"),
    ("Licensed under CC BY-ND 4.0.", "cc-by,cc-by-nd"),
    ("Licensed under CC BY-NC 4.0.", "cc-by,cc-by-nc"),
    ("Licensed under CC BY-NC-SA 3.0.", "cc-by,cc-by-nc-sa"),
    ("This work is licensed under a Creative Commons Attribution 4.0 International License", "cc-by"),
    ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License", "cc-by-sa"),
    ("This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License", "cc-by-nc"),
    ("Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License", "cc-by-nc-nd"),
    ("This work is licensed under a Creative Commons Attribution-NonCommercial-Share Alike 3.0 International License", "cc-by-nc-sa"),
    ("it under the terms of the GNU General Public License as published by: This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License", "gpl,gpl-notice"),
    ("This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License", "gpl,lgpl"),
    ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License", "agpl,gpl"),
    ("Licensed under the Apache License, Version 2.0 (the License)", "apache"),
    ("Licensed under the Apache License, Version 1.1", "apache-1.1"),
    ("This program and the accompanying materials are made available under the terms of the Eclipse Public License v2.0", "epl"),
    ("This Source Code Form is subject to the terms of the Eclipse Public License, v. 2.0", ""),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "mpl"),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files", "mit"),
    ("Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license", "bsl"),
    ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted", "isc"),
    ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met", "bsd"),
    ("This is free and unencumbered software released into the public domain.", "unlicense"),
    ("Licensed under the Plain License, Version 2.0", ""),
]


def test_confusable_notices_have_their_own_label(spark):
    filler = " ".join(f"w{i}" for i in range(400))
    rows = [(i, t) for i, (t, _) in enumerate(CONFUSABLE)] + [(100 + i, f"{filler} {t} {filler}") for i, (t, _) in enumerate(CONFUSABLE)]
    # One after the other, apart: each keeps its label.
    rows.append((999, f" {filler} ".join(t for t, _ in CONFUSABLE)))
    got = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, (text, want) in enumerate(CONFUSABLE):
        assert got[i].labels == got[100 + i].labels == want, text
    assert set(got[999].labels.split(",")) == {x for _, want in CONFUSABLE for x in want.split(",") if x}


def test_inserted_words_lower_the_score(spark):
    texts = ["licensed under the apache license version 2 0", "licensed under now the apache license version 2 0", "licensed under now and then the apache license version 2 0"]
    got = {r.doc_id: r.score for r in licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert got[0] == 1 > got[1] > got[2] > 0


def test_license_spans_equal_brute_force(spark):
    source = random.Random(9)
    notices = [("a", "one two three four five six", "three four"), ("b", "one two three nine four five six", "nine four"), ("c", "seven eight one two", "")]
    vocabulary = "one two three four five six seven eight nine ten".split()
    texts = [" ".join(source.choice(vocabulary) for _ in range(n)) + " " + source.choice(notices)[1] for n in range(60)]
    texts += [" ".join(w for _, t, _ in notices for w in [*t.split(), source.choice(vocabulary)]) for _ in range(5)]

    def labels(words):
        found = []
        for number, (label, text, name) in enumerate(notices):
            parts, own = text.split(), name.split()
            grams = list(zip(parts, parts[1:]))
            at = next((i for i in range(len(parts)) if parts[i : i + len(own)] == own), 0)
            needed = set(range(at, at + len(own) - 1))
            hits = sorted((p - q, p, q) for p, g in enumerate(zip(words, words[1:])) for q, h in enumerate(grams) if g == h)
            runs = []
            for hit in hits:
                if not runs or hit[0] - runs[-1][-1][0] > licenses.DRIFT:
                    runs.append([])
                runs[-1].append(hit)
            for run in runs:
                seen, first, end = {q for _, _, q in run}, min(p for _, p, _ in run), max(p for _, p, _ in run) + 2
                cover, density = len(seen) / len(grams), len(seen) / (end - first - 1)
                if needed <= seen and cover >= licenses.MIN_COVER and density >= licenses.MIN_DENSITY:
                    found.append((label, first, end, cover, (cover, len(seen), -number), cover * min(density, 1)))
        best = [f for f in found if not any(f[0] != g[0] and f[1] < g[2] and g[1] < f[2] and f[4] < g[4] for g in found)]
        return ",".join(sorted({f[0] for f in best})), max((f[5] for f in best), default=0.0)

    rows = licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), (), notices).collect()
    assert len(rows) == len(texts) and len({r.labels for r in rows}) > 3
    for r in rows:
        want, score = labels(texts[r.doc_id].split())
        assert (r.labels, r.score) == (want, pytest.approx(score)), texts[r.doc_id]


def test_url_rules_and_templates(spark):
    urls = ["http://a.example.org/es/1?x", "https://Example.ORG/en/12", "ftp://x.com/fr/1", "http://x.com/de/2#a", "http://other.net", None, "no scheme", "http://h.net/p/q/", "http://notexample.org.net/es/"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: r for r in url_filters.judge(pages).collect()}
    assert [got[i].rule for i in range(9)] == ["example.org/es/", "example.org/en/1", "com/fr/", "com/de/", None, None, None, None, None]
    assert [got[i].verdict for i in range(4)] == ["block", "block", "allow", "block"]
    assert (got[0].host, got[0].path, got[4].host, got[4].path) == ("a.example.org", "/es/1", "other.net", "")
    assert got[5].host == got[6].path == ""
    labelled = [(i, f"http://s.net/{'bad' if i % 2 else 'good'}/{i}", i % 2) for i in range(200)] + [(900, "http://s.net/bad/77x7", None)]
    table = spark.createDataFrame(labelled, "page_id long, url string, blocked int")
    judged = {r.page_id: r for r in url_filters.judge(table, table.where("blocked is not null").select("page_id", "blocked"), ()).collect()}
    assert judged[900].template == "/bad/*" and judged[900].verdict == "block" and judged[2].verdict == "allow"
    assert url_filters.judge(pages.limit(0)).count() == 0


def test_url_sections_far_down(spark):
    deep = [(i, f"http://d.net/a/b/c/d/e/f/{'bad' if i % 2 else 'good'}/p{i}/end", i % 2) for i in range(200)]
    six = [(1000 + i, f"http://six.net/a/b/c/d/e/{'bad' if i % 2 else 'good'}", i % 2) for i in range(200)]
    table = spark.createDataFrame(deep + six, "page_id long, url string, blocked int")
    for r in url_filters.judge(table, table.select("page_id", "blocked"), ()).collect():
        assert r.verdict == ("block" if r.page_id % 2 else "allow")
        assert r.template == ("/*" * 6 + f"/{'bad' if r.page_id % 2 else 'good'}/*/*" if r.page_id < 1000 else "/*" * 5 + f"/{'bad' if r.page_id % 2 else 'good'}")


def test_url_section_among_many_slugs(spark):
    name = lambda i: "".join(chr(97 + i // 26**k % 26) for k in range(3))
    slugs = [(i, f"http://m.net/{name(i)}/page", 0) for i in range(600)]
    spam = [(1000 + i, f"http://m.net/spam/{name(i)}", 1) for i in range(400)]
    table = spark.createDataFrame(slugs + spam, "page_id long, url string, blocked int")
    for r in url_filters.judge(table, table.select("page_id", "blocked"), ()).collect():
        assert (r.template, r.verdict) == (("/spam/*", "block") if r.page_id >= 1000 else ("/*/*", "allow"))


def test_url_sections_are_not_blocked_by_their_neighbours(spark):
    pages = [(10 * k + i, f"http://n.net/{name}/{i}", label) for k, (name, label) in enumerate([("de", 1), ("fr", 0), ("en", None)]) for i in range(5)]
    pages += [(100 + i, f"http://n.net/mp3/{i}", 0) for i in range(6)] + [(200 + i, f"http://n.net/web2/{i}", 1) for i in range(6)]
    table = spark.createDataFrame(pages, "page_id long, url string, blocked int")
    got = {r.page_id: r for r in url_filters.judge(table, table.where("blocked is not null").select("page_id", "blocked"), ()).collect()}
    for i, _, label in pages:
        assert got[i].verdict == ("block" if label else "allow")
    assert len({got[i].template for i in (0, 10, 20)}) == 3 and got[0].template == got[200].template != got[100].template == got[10].template


def tree(rows, depth=0, template=""):
    """Templates of (segments, labelled, blocked), by plain recursion."""
    out = {}
    groups = defaultdict(list)
    for r in rows:
        if len(r[0]) == depth:
            out[r[0]] = template
        else:
            groups[url_filters.ANY if re.search(url_filters.VARIABLE, r[0][depth]) else r[0][depth]].append(r)
    here = [r for g in groups.values() for r in g]
    labelled, blocked = sum(r[1] for r in here), sum(r[2] for r in here)
    if blocked in (0, labelled):
        return out | {r[0]: template + "/*" * (len(r[0]) - depth) for r in here}
    many = len(here) >= url_filters.MIN_PATHS and len(groups) > url_filters.MAX_DISTINCT * len(here)
    kinds = defaultdict(list)
    for name, g in groups.items():
        kinds["*" if many and len(g) < url_filters.MIN_PATHS else name] += g
    counts = {k: (sum(r[1] for r in g), sum(r[2] for r in g)) for k, g in kinds.items()}
    parts = {0: sorted((k for k in kinds if counts[k][0]), key=lambda k: counts[k][1] / counts[k][0])}
    for _ in range(url_filters.DIVISIONS):
        after = {}
        for part, names in parts.items():
            share = lambda some: sum(counts[k][1] for k in some) / sum(counts[k][0] for k in some)
            size = lambda some: sum(counts[k][0] for k in some)
            best = (0.0, 0.0, len(names))
            for c in range(1, len(names)):
                if share(names[c - 1 : c]) < share(names[c : c + 1]):
                    low, high, p = names[:c], names[c:], share(names)
                    z = (share(high) - share(low)) / math.sqrt(p * (1 - p) * (1 / size(low) + 1 / size(high)))
                    best = max(best, (z, share(names[c - 1 : c]), c))
            cut = best[2] if best[0] >= url_filters.MIN_Z else len(names)
            after |= {2 * part: names[:cut]} | ({2 * part + 1: names[cut:]} if cut < len(names) else {})
        parts = after
    for kind, g in kinds.items():
        part = next((p for p, names in parts.items() if kind in names), None)
        if part is None:
            step = "?"
        elif len(parts[part]) == 1 and len(parts) > 1:
            step = kind
        else:
            step = "*" if part == min(parts) else f"*{part}"
        groups_out = [(r, step) for r in g]
        out |= {r[0]: (s, r) for r, s in groups_out}
    by_step = defaultdict(list)
    for key, value in list(out.items()):
        if isinstance(value, tuple):
            by_step[value[0]].append(value[1])
            del out[key]
    for step, g in by_step.items():
        out |= tree(g, depth + 1, f"{template}/{step}")
    return out


def test_url_templates_equal_a_recursive_tree(spark):
    source = random.Random(31)
    names = ["a", "b", "c", "d", "e", "12", "x345", "mp3"]
    bias = {n: source.choice([0.0, 0.1, 0.5, 0.9, 1.0]) for n in names}
    paths = {tuple(source.choice(names) for _ in range(source.randint(0, 4))) for _ in range(600)}
    rows = []
    for p in sorted(paths):
        labelled = source.choice([0, 1, 3])
        rows.append((p, labelled, sum(source.random() < (bias[p[0]] if p else 0.5) for _ in range(labelled))))
    given_rows = [("h", "/" + "/".join(p), 1, l, b) for p, l, b in rows]
    got = url_filters.path_templates(spark.createDataFrame(given_rows, "host string, path string, n long, labelled long, blocked long")).collect()
    want = {"/" + "/".join(p): t for p, t in tree(rows).items()}
    assert {r.path: r.template for r in got} == want and len(set(want.values())) > 5


def fingerprint(text):
    ws = (text or "").translate(UPPER).encode().split()
    shingles = [b" ".join(ws[i : i + 3]) for i in range(len(ws) - 2)] if len(ws) > 2 else [b" ".join(ws)] * bool(ws)
    hashes = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints(docs, empty):
    named = simhash.near_duplicates(docs).collect()
    want = Counter((i, fingerprint(t)) for i, t in given(docs))
    assert Counter((r.doc_id, r.fp % (1 << 64)) for r in named) == want
    assert simhash.near_duplicates(empty).count() == 0


@pytest.mark.parametrize("members", [64, 0.001])
def test_components_are_exact(spark, members, monkeypatch):
    monkeypatch.setattr(simhash, "NODE_MEMBERS", members)
    source = random.Random(9)
    fps = set()
    for _ in range(40):
        fp = source.getrandbits(64)
        for _ in range(source.randint(1, 12)):
            fps.add(fp)
            for _ in range(source.randint(1, 4)):
                fp ^= 1 << source.randrange(64)
    signed = sorted(f - (1 << 64) if f >> 63 else f for f in fps)
    parent = {f: f for f in signed}

    def root(f):
        return f if parent[f] == f else root(parent[f])

    for a in signed:
        for b in signed:
            if ((a ^ b) % (1 << 64)).bit_count() <= 3:
                parent[max(root(a), root(b))] = min(root(a), root(b))
    if members < 1:
        monkeypatch.setattr(simhash, "_plan", lambda n, bits: ([(i * 12, 12) for i in range(4)] + [(48, 16)], 2))
    got = {r.fp: r.component for r in simhash.fingerprint_components(spark.createDataFrame([(f,) for f in signed], "fp long")).collect()}
    assert got == {f: root(f) for f in signed}


def test_components_of_a_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (7, 7)], "a long, b long")
    assert {r.node: r.component for r in components(links).collect()} == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def test_one_of_each_keeps_one_row(docs):
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    named = simhash.near_duplicates(docs)
    assert kept.count() == named.select("component_id").distinct().count()


def test_one_of_each_with_null_and_repeated_ids(spark):
    source = random.Random(10)
    made = [" ".join("".join(source.choice("abcdefghij") for _ in range(6)) for _ in range(60)) for _ in range(12)]
    ids = [None] * 5 + [7] * 5 + [8, 9]
    rows = [*zip(ids, made), (None, made[0]), (7, made[6]), (10, made[11])]
    kept = simhash.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter(map(tuple, kept)) == Counter(zip(ids, made))


def test_packing_is_whole_and_tight(docs, empty):
    model = tokenizers.Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = defaultdict(list)
    for i, t in given(docs):
        ids[i].append(model.encode(t or "", add_special_tokens=False).ids + [1])
    rows = packing.pack(docs, shard_docs=8).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        own = np.frombuffer(r.ids, "<u4").tolist()
        assert len(own) == r.length and zlib.crc32(bytes(r.ids)) == r.ids_crc32
        assert own == ids[r.doc_id][0][r.start : r.start + r.length] and r.doc_tokens == len(ids[r.doc_id][0])
        by_doc[r.doc_id].append((r.start, r.length))
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for i, copies in ids.items():
        covered = Counter(k for s, n in by_doc[i] for k in range(s, s + n))
        assert covered == Counter({k: len(copies) for k in range(len(copies[0]))})
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048 and at & (at - 1) == 0
    assert packing.pack(empty).count() == 0


def test_packing_ids_equal_the_library_on_every_code_point():
    own = packing.Tokens(packing.VOCABULARY)
    points = [chr(c) for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000]
    low, high = points[:0x250], points[0x250:]
    texts = [t for c in low for t in (c, f"a{c}b", f"{c}{c} x{c}")] + [" ".join(f"a{c}b" for c in high[i : i + 64]) for i in range(0, len(high), 64)]
    for text, want in zip(texts, own.whole.encode_batch(texts, add_special_tokens=False)):
        assert own.of(text).tolist() == [*want.ids, packing.END_ID], text


def test_packing_cuts_each_distinct_chunk_once(monkeypatch):
    own = packing.Tokens(packing.VOCABULARY)
    odd = [None, "", " \n ", "<|endoftext|> A<|startoftext|>B", "J\u030c \u03a3\u03a3", "\x1c\x1da\tb\x85c\u00a0D", "It's 'S 12,34", "\u0130 \u023a", "\u4e2d the \u4e2d"]
    same = [f"The words, of many texts {i % 7}\nand \u00c9t\u00e9" for i in range(400)]
    scanned = []

    class Counted:
        findall = lambda _, text, cut=own.pattern: scanned.append(len(text)) or cut.findall(text)

    monkeypatch.setattr(own, "pattern", Counted())
    for slice_bytes in (4_000_000, 40):
        monkeypatch.setattr(packing, "SLICE_BYTES", slice_bytes)
        texts = pa.array([*same[:5], *odd, *same])
        scanned.clear()
        found = own.of_all(texts, "<u4").to_pylist()
        if slice_bytes > 40:
            assert sum(scanned) < 0.05 * sum(len(t) for t in same)
        for text, ids in zip(texts.to_pylist(), found):
            assert np.frombuffer(ids, "<u4").tolist() == [*own.whole.encode(text or "", add_special_tokens=False).ids, packing.END_ID], text
    assert own.of_all(texts.slice(3, 4), "<u2").to_pylist() == [np.frombuffer(i, "<u4").astype("<u2").tobytes() for i in found[3:7]]
    assert own.of_all(texts.slice(0, 0), "<u2").to_pylist() == []


def test_related_documents_meet_whatever_their_place(spark):
    source = random.Random(11)
    subjects = ["river stone bridge water", "piano violin chorus melody", "bread butter cheese onion", "engine wheel brake petrol"]
    # Subjects take turns, so that no two documents of one subject are near in the file.
    rows = [(i, " ".join(source.choice(subjects[i % 4].split()) for _ in range(700))) for i in range(64)]
    pieces = packing.pack(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), shard_docs=4).collect()
    of = defaultdict(set)
    for r in pieces:
        of[r.sequence_id].add(r.doc_id % 4)
    full = [s for s in of if sum(r.length for r in pieces if r.sequence_id == s) == packing.WINDOW]
    assert sum(len(of[s]) == 1 for s in full) >= 0.6 * len(full)


def test_index_ranks_by_bm25():
    class Given:
        idf, mean_length = np.array([1.0, 2.0, 0.5, 0.0], dtype=np.float32), 3.0

    lists = [np.array(x) for x in ([0, 1, 3], [1, 1, 2], [2, 3], [3])]
    index = packing.Index(lists, Given)
    want = [sum(Given.idf[t] * (tf := (d == t).sum()) * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(d) / 3)) for t in set(lists[0].tolist())) for d in lists]
    assert index.scores(0) == pytest.approx(want, rel=1e-5)
    assert index.scores(3).tolist() == [0, 0, 0, 0]


def test_quality_measures(docs, empty):
    judged = quality.with_quality(docs).collect()
    model = quality.Tokens(quality.VOCABULARY)
    for r in judged:
        text = r.text or ""
        ws = re.findall(r"[^\x20\x09-\x0D]+", text)
        windows = Counter(zip(ws, ws[1:], ws[2:]))
        repeated = {k + j for k, w in enumerate(zip(ws, ws[1:], ws[2:])) if windows[w] > 1 for j in range(3)}
        lines = [x for x in text.split("\n") if x.strip(" \t\n\r\x0b\x0c")]
        q = r.quality
        assert (q.n_words, q.word_chars, q.n_repeat_words) == (len(ws), sum(map(len, ws)), len(repeated))
        assert (q.n_symbols, q.n_dup_lines) == (sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)))
        assert q.base_failed == (len(ws) < 50 or 100 * len(repeated) > 50 * len(ws))
        assert q.n_tokens == len(model.model.encode(text))
        assert not (q.kept and q.base_failed)
    assert quality.of_quality(docs.withColumn("quality", F.lit(1))).columns == [*docs.columns, "quality"]
    assert quality.with_quality(empty).count() == 0


def test_bands_reject_odd_texts(spark):
    source = random.Random(2)
    plain = [" ".join(source.choice("the house of many small green stones stands near water".split()) for _ in range(90)) for _ in range(300)]
    odd = "".join(chr(source.randrange(0x1F300, 0x1F5FF)) + " " for _ in range(90))
    rows = [(i, t, "en") for i, t in enumerate([*plain, odd])]
    kept = {r.doc_id for r in quality.of_quality(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert 300 not in kept and len(kept) >= 295


def test_fertility_rejects_what_the_base_rules_pass(spark):
    source = random.Random(12)
    words = "the house of many small green stones stands near water while people walk along narrow roads".split()
    plain = [" ".join(source.choice(words) for _ in range(120)) for _ in range(300)]
    # Symbols after a word in three: somewhat fewer characters a token, nothing repeated and enough words.
    junk = [" ".join(source.choice(words) + ("###" if k % 3 == 0 else "") for k in range(120)) for _ in range(10)]
    copies = [plain[0]] * 900
    rows = spark.createDataFrame([(i, t, "en") for i, t in enumerate([*plain, *junk, *copies])], "doc_id long, text string, lang string")
    judged = {r.doc_id: r.quality for r in quality.with_quality(rows).collect()}
    assert not any(q.base_failed for q in judged.values())
    assert not any(judged[i].kept for i in range(300, 310))
    # Copies neither hide the others' spread nor fall out themselves.
    assert sum(judged[i].kept for i in range(300)) >= 295 and all(judged[i].kept for i in range(310, 1210))


def test_rare_languages_are_judged_by_their_script_or_by_all(spark):
    source = random.Random(21)
    words = "the house of many small green stones stands near water while people walk along narrow roads".split()
    plain = lambda: " ".join(source.choice(words) for _ in range(120))
    junk = lambda: " ".join(source.choice(words) + ("###" if k % 3 == 0 else "") for k in range(120))
    symbols = " ".join(chr(source.randrange(0x1F300, 0x1F5FF)) for _ in range(90))
    texts = [(plain(), "en") for _ in range(200)] + [(junk(), "xx"), (plain(), "xx"), (junk(), None), (symbols, "yy"), (plain(), "yy")]
    rows = spark.createDataFrame([(i, *t) for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    judged = {r.doc_id: r.quality for r in quality.with_quality(rows).collect()}
    # xx and the texts without a language stand in the band of Latin script, yy's symbols (no script) in that of all.
    assert [judged[i].kept for i in range(200, 205)] == [False, True, False, False, True]
    # Alone in its table a text is the middle of the band.
    assert quality.of_quality(rows.where("doc_id = 0")).count() == 1


def test_leaks_within_the_budget(spark, empty):
    source = random.Random(4)
    letters = "abcdefghijklmnopqrstuvwxyz   "
    items = ["".join(source.choice(letters) for _ in range(n)) for n in (60, 120, 300)]
    edited = list(decontamination.normalised(items[2]))
    for k in (10, 90, 200, 250):
        edited[k] = "#"
    bench = spark.createDataFrame([*enumerate(items), (7, None), (8, " "), (9, items[0])], "item_id long, text string")
    rows = [(0, "before " + items[1].upper() + " after"), (1, "x " + "".join(edited)), (2, "clean text"), (3, None), (4, ""), (5, items[0]), (6, items[2][:150])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    places = {(r.doc_id, r.item_id, r.distance) for r in decontamination.find_leaks(docs, bench).collect()}
    assert places == {(0, 1, 0), (1, 2, 4), (5, 0, 0), (5, 9, 0)}
    assert {r.doc_id for r in decontamination.without_leaks(docs, bench).collect()} == {2, 3, 4, 6}
    assert decontamination.find_leaks(empty, bench).count() == 0
    assert decontamination.without_leaks(docs, bench.limit(0)).count() == 7


def test_items_without_id_are_searched(spark):
    item = "what is the name of the longest river that flows through the old town"
    bench = spark.createDataFrame([(None, item), (3, item), (None, None)], "item_id long, text string")
    docs = spark.createDataFrame([(0, f"so {item} then"), (1, "clean text")], "doc_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontamination.find_leaks(docs, bench).collect()} == {(0, None), (0, 3)}
    assert [r.doc_id for r in decontamination.without_leaks(docs, bench.where("item_id is null")).collect()] == [1]


def test_best_place_is_the_nearest():
    source = random.Random(6)
    for _ in range(200):
        item, text = ("".join(source.choice("abc") for _ in range(source.randint(low, 25))) for low in (1, 0))
        row = [0] * (len(text) + 1)
        for i, x in enumerate(item, 1):
            new = [i]
            for j, y in enumerate(text, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        assert decontamination.Pattern(item).best(text)[0] == min(row)


def test_long_texts_in_pieces_have_the_same_strings(monkeypatch):
    text = random.Random(8).randbytes(1000).replace(b"\xff", b"a")
    whole, lengths = context_tree.strings([text])
    for block in (1, 7, 1000, 1001, 5000):
        monkeypatch.setattr(context_tree, "BLOCK_BYTES", block)
        assert np.concatenate(list(context_tree.long_strings(text, context_tree.DEPTH))).tolist() == whole.tolist()
    assert lengths.tolist() == [1001]
    keys, counts = context_tree._added(np.array([5, 3, 5, 5]), np.array([1 << 32, 1 << 32 | 1, 1 << 32 | 1, 1 << 32 | 1]))
    assert keys.tolist() == [3, 5] and (counts & 0xFFFFFFFF).tolist() == [1, 2] and (counts >> 32).tolist() == [1, 3]
