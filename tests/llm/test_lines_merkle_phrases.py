"""Line dedup, Merkle manifest and phrase mining against brute force, with odd rows and empty tables."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnline.llm import lines, merkle, phrases

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BLANKS = " \t\n\x0b\x0c\r"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, lines int, place int, at int, tree string, part int, n int"


def rows_of(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3, "t", 4, 5) for r in rows], SCHEMA).repartition(4)


def corpus(seed=21):
    source = random.Random(seed)
    shared = [f"This Line Is Shared By many documents of the corpus, number {i}" for i in range(4)] + ["É" + "x" * 39, "y" * 39, "日本" * 20]
    rows = []
    for i in range(60):
        own = [f"own line {i} {k} " + "w" * source.randint(0, 60) for k in range(source.randint(0, 6))]
        text = [*own, *source.choices(shared, k=source.randint(0, 5))]
        source.shuffle(text)
        text = [source.choice(["", " ", "\t"]) + (x.upper() if source.random() < 0.3 else x) + source.choice(["", "\r", " \x0b"]) for x in text]
        rows.append((i, "\n".join(text), source.choice(["en", "de", None]), source.choice(["a", "b", "B", "é", None]), len(text)))
    rows += [(None, "\n".join(shared), "en", None, None), (None, "\n".join(shared), "en", None, None), (None, shared[0], None, "a", 1)]
    rows += [(100, None, None, "c", None), (101, "", "en", "c", 0), (102, "\n\n", "en", "only", 2), rows[0], (1, shared[1] + "\n" + shared[1], "en", "a", 3)]
    rows.append((103, "\n".join(f"a very long text in which every line is of its own, {k} of many" for k in range(20_000)) + "\n" + shared[2], "en", "a", 9))
    return rows


# ---- lines ---------------------------------------------------------------------------------


def brute_lines(rows):
    key = lambda x: x.strip(BLANKS).translate(UPPER)
    holders = defaultdict(set)
    for i, t, *_ in rows:
        for x in (t or "").split("\n"):
            if len(key(x)) >= 40:
                holders[key(x)].add(-1 if i is None else i)
    out = Counter()
    for i, t, *_ in rows:
        every = (t or "").split("\n")
        kept = [x for x in every if len(holders[key(x)]) < 5 or max(holders[key(x)]) == i]
        out[i, len(every), len(every) - len(kept), "\n".join(kept)] += 1
    return out


@pytest.mark.parametrize("share", [lines.HOT_SHARE, 1, 3])
def test_lines_equal_brute_force(spark, monkeypatch, share):
    # With a small share nearly all hashes are joined rather than sent along.
    monkeypatch.setattr(lines, "HOT_SHARE", share)
    rows = corpus()
    docs = rows_of(spark, rows)
    done = lines.with_unique_lines(docs, column="unique")
    assert done.columns == [*docs.columns, "unique"]
    got = Counter((r.doc_id, r.unique.n_lines, r.unique.n_dropped, r.unique.kept) for r in done.collect())
    want = brute_lines(rows)
    assert got == want and sum(n for (_, _, d, _), n in want.items() if d) > 20


def test_no_lines(spark):
    docs = rows_of(spark, corpus())
    assert lines.with_unique_lines(docs.limit(0)).count() == 0
    nothing = lines.with_unique_lines(docs.where("text is null").drop("lines")).collect()
    assert [(r.lines.n_lines, r.lines.n_dropped, r.lines.kept) for r in nothing if r.doc_id == 100] == [(1, 0, "")]


def test_a_line_in_all_documents_is_kept_once(spark):
    line = "the same line stands in each and every document of this table"
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit(line).alias("text")).repartition(7)
    kept = lines.with_unique_lines(docs).where("lines.kept <> ''").select("doc_id").collect()
    assert [r.doc_id for r in kept] == [2999]


# ---- Merkle --------------------------------------------------------------------------------


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    i, _, lang, source, n = row
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (i, source, lang, n, text)))


def climb(level):
    """All levels of a tree, leaves first."""
    out = [level]
    while len(out[-1]) > 1:
        out.append([sha(*out[-1][k : k + 3]) for k in range(0, len(out[-1]), 3)])
    return out


def way(levels, at, digest):
    siblings = []
    for level in levels[:-1]:
        first = at - at % 3
        run = level[first : first + 3]
        siblings += [d for k, d in enumerate(run) if first + k != at]
        run[at - first] = digest
        digest, at = sha(*run), at // 3
    return siblings, digest


def brute_merkle(rows):
    groups = defaultdict(list)
    for r in rows:
        text = r[1]
        if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and text is not None:
            text = text.replace("\n", "")
        groups["" if r[3] is None else "s" + r[3]].append((r[0], leaf(r, r[1]), leaf(r, text)))
    names = sorted(groups, key=str.encode)
    trees = {}
    for name in names:
        groups[name].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[name] = climb([d for _, d, _ in groups[name]])
    top = climb([trees[n][-1][0] for n in names])
    out = Counter()
    for number, name in enumerate(names):
        for at, (i, own, claimed) in enumerate(groups[name]):
            below, found = way(trees[name], at, claimed)
            above, root = way(top, number, found)
            out[i, own, trees[name][-1][0], "".join([*below, *above]), root] += 1
    return out, top[-1][0]


@pytest.mark.parametrize("levels", [merkle.BLOCK_LEVELS, 1, 2, 3])
def test_merkle_equals_brute_force(spark, levels):
    # Low blocks make many bands of them, in the sources' trees and in the one above.
    rows = corpus()
    found = merkle.manifest(rows_of(spark, rows), merkle.leaf_digest({"text": merkle.tampered_text()}), levels)
    want, root = brute_merkle(rows)
    assert found.root() == root
    assert Counter(map(tuple, merkle.proofs(found).collect())) == want
    assert any(w[4] != root for w in want) and any(w[4] == root for w in want)


def test_manifest_blocks_hold_every_node(spark):
    rows = corpus()
    found = merkle.manifest(rows_of(spark, rows))
    of_source = Counter("" if r[3] is None else "s" + r[3] for r in rows)
    held = {r.tree: r for r in found.blocks().where("scope = 'source' and band = 0").collect()}
    assert {t: r.leaves for t, r in held.items()} == of_source
    for r in held.values():
        nodes = np.frombuffer(r.nodes, np.uint8).reshape(-1, merkle.DIGEST)
        assert (nodes.any(axis=1)).sum() == sum(merkle.level_sizes(r.leaves, r.height))


def test_van_emde_boas_addresses():
    for levels in range(1, 9):
        places = np.concatenate([merkle.address(d, np.arange(3**d), levels) for d in range(levels)])
        assert sorted(places.tolist()) == list(range(merkle.size_of(levels)))
    # Three levels: the root, then each child with its own children.
    assert merkle.address(1, np.arange(3), 3).tolist() == [1, 5, 9]
    assert merkle.address(2, np.arange(9), 3).tolist() == [2, 3, 4, 6, 7, 8, 10, 11, 12]


def test_single_and_no_documents(spark):
    docs = rows_of(spark, corpus())
    none = merkle.manifest(docs.limit(0))
    assert none.root() is None and merkle.proofs(none).count() == 0
    one = merkle.manifest(docs.where("doc_id = 102"))
    r = merkle.proofs(one).first()
    assert r.leaf == r.subroot == r.folded_root == one.root() and r.proof == ""


# ---- phrases -------------------------------------------------------------------------------


def prose(seed=5, n=150):
    source = random.Random(seed)
    words = "new york city state bank of the river Über x1 a b".split()
    made = []
    for i in range(n):
        parts = [source.choice([*words, "New York City", "bank of the river", "a a a", "b\ta"]) + source.choice(["", "", "", ",", ".", "\n", "!? "]) for _ in range(source.randint(0, 40))]
        made.append((source.choice([i, i, None]), " ".join(parts), source.choice(["en", "en", "de", None])))
    long = " ".join(source.choice(words) for _ in range(5000))
    return [*made, made[3], made[3], (900, None, "en"), (901, "", "de"), (902, " .,; \t", "fr"), (903, long, "en"), (904, "a� b " * 30, "xx"), (905, ". ".join(["one two three"] * 12), "und")]


def brute_phrases(rows, top, least=10):
    counts, totals = Counter(), Counter()
    for _, text, lang in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UPPER)):
            ws = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(ws)
            counts.update((lang, *ws[k : k + n]) for n in (1, 2, 3) for k in range(len(ws) - n + 1))
    out = defaultdict(list)
    for (lang, *p), a in counts.items():
        if len(p) == 1 or a < least:
            continue
        if any(100 * b >= 50 * a for q, b in counts.items() if b >= least and len(p) == 2 and len(q) == 4 and q[0] == lang and p in (list(q[1:3]), list(q[2:4]))):
            continue
        cuts = [(10**6 * a * a // (counts[lang, *p[:k]] * counts[lang, *p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        out[lang].append((-score, -a, " ".join(p).encode(), counts[lang, *p[:k]], counts[lang, *p[k:]]))
    return {(lang, r, p.decode(), -a, x, y, totals[lang], -s) for lang, found in out.items() for r, (s, a, p, x, y) in enumerate(sorted(found)[:top], 1)}


@pytest.mark.parametrize(
    ("top", "sample", "sample_least", "block", "share"),
    [(2000, 8, 2, phrases.BLOCK_BYTES, phrases.HOT_SHARE), (15, 3, 1, 300, 4), (2000, 10**9, 2, 2000, 1)],
)
def test_phrases_equal_brute_force(spark, monkeypatch, top, sample, sample_least, block, share):
    # The last case draws no sample at all: every phrase comes from border failures.
    monkeypatch.setattr(phrases, "HOT_SHARE", share)
    rows = prose()
    docs = spark.createDataFrame([(*r, "s", 1) for r in rows], "doc_id long, text string, lang string, phrase string, n int").repartition(5)
    got = {tuple(r) for r in phrases.collocations(docs, top, sample=sample, sample_least=sample_least, block_bytes=block, filter_bits=16).collect()}
    assert got == brute_phrases(rows, top)


def test_passes_count_each_phrase_once(spark, monkeypatch):
    docs = spark.createDataFrame(prose(), "doc_id long, text string, lang string")
    passes, one = [], phrases.full_pass
    monkeypatch.setattr(phrases, "full_pass", lambda *given: passes.append(one(*given)) or passes[-1])
    for sample in (2, 10**9):
        passes.clear()
        phrases.survivors(docs, 10, sample, 2, 16, 2000)
        keys = [r.key for found in passes for r in found.collect()]
        # Without a sample the words come in the first pass, pairs in the second, triples in the third.
        assert len(keys) == len(set(keys)) and len(passes) >= (3 if sample > 2 else 1)


def test_scores_beyond_64_bits(spark):
    a, left, right = 3_000_000_000_000, 4_000_000_000_001, 5_000_000_000_003
    r = spark.createDataFrame([(a, left, right)], "a long, l long, r long").select(phrases._score(F.col("a"), F.col("l"), F.col("r")).alias("s")).first()
    assert r.s == 10**6 * a * a // (left * right)


def test_no_phrases(spark):
    docs = spark.createDataFrame(prose(), "doc_id long, text string, lang string")
    assert phrases.collocations(docs.limit(0)).count() == 0
    assert phrases.collocations(docs.where("text is null or length(text) < 9")).count() == 0
