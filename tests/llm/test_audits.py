"""Filter audit, SimHash and source divergence against brute force."""

import itertools
import random
import re
from collections import Counter, defaultdict
from math import comb

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from payscope.llm import filter_audit, simhash, source_divergence
from payscope.llm.queries import QUERIES
from tests.llm.fixtures import documents, edge_texts, empty_documents, prose

SF = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LABELS = "doc_id long, quality int, toxic int"


def rows_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


# filter audit

def audit_truth(rows, labels):
    """rows: (doc_id, text, source); labels: (doc_id, quality, toxic)."""
    good = {k for k, q, _ in labels if q == 1 and k is not None}
    toxic = {k for k, _, t in labels if t == 1 and k is not None}
    ids = defaultdict(list)
    for k, t, _ in rows:
        if k is not None:
            ids[t or ""].append(k)
    parts = defaultdict(list)
    for k, t, s in rows:
        t = t or ""
        words = WORDS.findall(t)
        fails = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
                 "D": bool(re.search(r"[#$%&*|]", t)), "E": k is not None and k > min(ids[t])}
        parts[s or ""].append((k, {f for f, bad in fails.items() if bad}))
    out = {}
    for part, docs in parts.items():
        shapley = Counter()
        for order in itertools.permutations("ABCDE"):
            left = docs
            for k, f in enumerate(order):
                kept = [x for x in left if f not in x[1]]
                gone = [x for x in left if f in x[1]]
                shapley[f] += len(gone)
                out[part, "".join(order), k + 1] = [len(kept), len(gone), sum(f in x[1] for x in docs) - len(gone), sum(x[1] == {f} for x in docs),
                                                    sum(x[0] in good for x in gone), sum(x[0] in toxic for x in gone)]
                left = kept
        for key in out:
            if key[0] == part:
                out[key].append(shapley[key[1][key[2] - 1]])
    return {k: tuple(v) for k, v in out.items()}


def audited(df):
    rows = df.collect()
    out = {(x.part, x.filter_order, x.step): tuple(x[c] for c in filter_audit.COUNTS) for x in rows}
    assert len(out) == len(rows)
    return out


def test_filter_audit(spark):
    r = random.Random(5)
    base = prose(71, 25) + [t + " $5" for t in prose(72, 4)] + [t.upper() for t in prose(73, 4)] + [" ".join(prose(74, 3)), "a b " * 150, "A" * 99_000 + " x" * 999]
    texts = edge_texts() + [r.choice(base) for _ in range(120)] + base
    rows = [(k, t, "en", r.choice(["src0", "src0", "src1", "", None]), 0) for k, t in enumerate(texts)]
    rows += [rows[30], rows[30], (None, base[0], "en", "src0", 0), (None, base[0], "en", None, 0), (None, None, None, None, None), (2**62, base[1], "de", "src1", 0)]
    labels = [(k, r.choice([0, 1, None]), r.choice([0, 0, 1])) for k in range(0, len(texts), 2)] + [(4, 1, 1), (4, 0, 0), (None, 1, 1), (10**9, 1, 1)]
    docs = rows_of(spark, rows).select("*", *[F.lit(1).alias(c) for c in ("digest", "id", "part", "bits", "n", "good", "toxic", "first", "same")])
    got = audited(filter_audit.audit(docs, spark.createDataFrame(labels, LABELS).withColumn("n", F.lit(3))))
    assert got == audit_truth([(k, t, s) for k, t, _, s, _ in rows], labels)
    assert filter_audit.audit(empty_documents(spark), spark.createDataFrame([], LABELS)).count() == 0
    without = audited(filter_audit.audit(docs, spark.createDataFrame([], LABELS)))
    assert set(without) == set(got) and not any(v[4] or v[5] for v in without.values())


def test_contraction_selects_along_axes():
    r = np.random.default_rng(3)
    counts = r.integers(0, 50, (32, 3))
    part = filter_audit.audit_part(np.arange(32), counts).set_index(["filter_order", "step"])
    x = part.loc[("CAEBD", 3)]  # E, after C and A
    fails = [{f for k, f in enumerate("ABCDE") if cell >> k & 1} for cell in range(32)]
    assert x.removed == sum(c[0] for c, f in zip(counts, fails, strict=True) if "E" in f and not f & {"C", "A"})
    assert x.good_lost == sum(c[1] for c, f in zip(counts, fails, strict=True) if "E" in f and not f & {"C", "A"})
    assert x.kept == sum(c[0] for c, f in zip(counts, fails, strict=True) if not f & {"C", "A", "E"})
    assert x.unique_fails == counts[fails.index({"E"})][0]
    assert (part.groupby("filter_order").removed.sum() == counts[1:, 0].sum()).all()


# SimHash

def print_truth(text):
    words = [w.translate({k: k + 32 for k in range(65, 91)}) for w in WORDS.findall(text or "")]
    shingles = [" ".join(words[k:k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_truth(prints):
    """Smallest member of each distinct fingerprint's component."""
    held = np.array(sorted(prints), np.uint64)
    root = {}
    for p in held.tolist():
        if p in root:
            continue
        root[p], todo = p, [p]
        while todo:
            near = held[np.bitwise_count(held ^ np.uint64(todo.pop())) <= 3]
            todo += [q for q in near.tolist() if q not in root]
            root.update((q, p) for q in near.tolist())
    return root


def simhash_truth(rows):
    prints = [print_truth(t) for _, t in rows]
    root = components_truth(set(prints))
    least = {}
    for (k, _), p in zip(rows, prints, strict=True):
        if k is not None:
            least[root[p]] = min(k, least.get(root[p], k))
    return sorted(((k, f"{p:016x}", least.get(root[p])) for (k, _), p in zip(rows, prints, strict=True)), key=str)


def test_spark_hashes_alike(spark):
    text = "naïve 漢字 words"
    assert spark.range(1).select(F.xxhash64(F.lit(text))).first()[0] % 2**64 == xxhash.xxh64_intdigest(text.encode(), simhash.SEED)


def test_code_is_perfect():
    _, patterns, many = simhash._golay()
    assert sorted(set(many.tolist())) == [1, 6] and sum(m == 6 for m in many) == comb(23, 3)
    light = np.bitwise_count(patterns[:, 0])
    assert [int((light == w).sum()) for w in range(4)] == [comb(23, w) for w in range(4)]


@pytest.mark.parametrize("errors", [1, 2])
def test_near_words_share_a_codeword(errors):
    r = np.random.default_rng(errors)
    words = r.integers(0, 1 << 23, 4000)
    for bits in list(itertools.combinations(range(23), errors))[::3]:
        other = words ^ sum(1 << b for b in bits)
        for one_error in ([False, True] if errors == 1 else [False]):
            (x, in_x), (y, in_y) = simhash.codewords(words, one_error), simhash.codewords(other, one_error)
            shared = ((x[:, :, None] == y[:, None, :]) & in_x[:, :, None] & in_y[:, None, :]).any(axis=(1, 2))
            assert shared.all()


@pytest.mark.parametrize("make_keys", [simhash.golay_keys, simhash.digit_keys])
def test_every_error_pattern_shares_a_key(make_keys):
    r = random.Random(8)
    patterns = [c for n in (1, 2) for c in itertools.combinations(range(64), n)] + r.sample(list(itertools.combinations(range(64), 3)), 1500)
    prints = np.array([r.getrandbits(64) for _ in patterns], np.uint64)
    other = prints ^ np.array([sum(1 << b for b in c) for c in patterns], np.uint64)

    def sets(p):
        out = [set() for _ in p]
        for row, tag, key in zip(*[x.tolist() for x in make_keys(p)], strict=True):
            out[row].add((tag, key))
        return out

    assert all(x & y for x, y in zip(sets(prints), sets(other), strict=True))


def clustered_prints(seed, n):
    r = random.Random(seed)
    out = {r.getrandbits(64) for _ in range(n)}
    for p in list(out)[: n // 4]:  # chains and dense groups
        for _ in range(r.choice([1, 3, 30])):
            p ^= sum(1 << b for b in r.sample(range(64), r.choice([1, 2, 3, 4])))
            out.add(p)
    dense = r.getrandbits(64)
    out |= {dense ^ sum(1 << b for b in r.sample(range(9), r.randint(0, 5))) for _ in range(300)}
    return out


@pytest.mark.parametrize("bucket", [simhash.BUCKET, 20])
def test_links_give_all_components(spark, bucket):
    prints = clustered_prints(6, 600)
    signed = np.array(sorted(prints), np.uint64).view(np.int64).tolist()
    found = simhash.near_links(spark.createDataFrame([(x,) for x in signed], "fp long"), bucket).collect()
    unsigned = lambda x: x % 2**64
    truth = components_truth(prints)
    root = {p: p for p in prints}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for x in found:
        a, b = top(unsigned(x.a)), top(unsigned(x.b))
        root[max(a, b)] = min(a, b)
    assert {p: top(p) for p in prints} == truth
    assert len(set(truth.values())) < len(truth)


def test_simhash_classes(spark):
    r = random.Random(9)
    texts = edge_texts() + prose(81, 30)
    for t in texts[-30:-10]:
        words = t.split()
        words[r.randrange(len(words))] = "changed"
        texts += [" ".join(words), t.title(), t.replace(" ", "\t\n")]
    rows = list(enumerate(texts)) + [(None, texts[-1]), (None, "alone without an id"), (3, texts[3]), (2**62, None)]
    docs = rows_of(spark, [(k, t, None, None, 0) for k, t in rows]).select("*", *[F.lit(1).alias(c) for c in ("fp", "a", "b", "least", "member", "root", "component")])
    got = sorted(((x.doc_id, x.fingerprint, x.component_id) for x in simhash.classes(docs).collect()), key=str)
    assert got == simhash_truth(rows)
    assert len({x[2] for x in got}) < len(got) - 20
    assert simhash.classes(empty_documents(spark)).count() == 0


def test_simhash_query(spark):
    rows = [(x.doc_id, x.text) for x in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = QUERIES["op12_simhash_near_dedup"](spark, SF)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted((tuple(x) for x in got.collect()), key=str) == simhash_truth(rows)


def test_long_texts_in_blocks(monkeypatch):
    text = " ".join(prose(83, 40)) + " " + "x" * 5000 + "\x0bEnd Of\tit"
    whole = simhash.fingerprint(text.encode()), Counter(b for x in source_divergence.terms_of(text.encode()) for b in x)
    assert whole[0] % 2**64 == print_truth(text)
    for size in (50, 999):
        monkeypatch.setattr(simhash, "TEXT_BLOCK", size)
        monkeypatch.setattr(source_divergence, "TEXT_BLOCK", size)
        assert simhash.fingerprint(text.encode()) == whole[0]
        assert Counter(b for x in source_divergence.terms_of(text.encode()) for b in x) == whole[1]


# source divergence

def divergence_truth(rows, least=3, top=200):
    """rows: (text, lang, source)."""
    counts, found, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        lower = (text or "").translate({k: k + 32 for k in range(65, 91)})
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower)
        counts[lang, source].update(terms)
        found[lang].update(set(terms))
    out = []

    def put(lang, source, part, values, most=None):
        ranked = sorted(values, key=lambda x: (-x[1], x[0].encode()))
        out.extend((lang, source, part, item, value, k + 1) for k, (item, value) in enumerate(ranked[:most]))

    for lang in {x for x, _ in groups}:
        kept = [t for t, n in found[lang].items() if n >= least]
        sources = [s for x, s in groups if x == lang]

        def shares(n, kept=kept):
            total = sum(n[t] for t in kept)
            return {t: 1 + 10**9 * (n[t] + 1) // (total + len(kept)) for t in kept}

        p = {s: shares(counts[lang, s]) for s in sources}
        q = shares(sum((counts[lang, s] for s in sources), Counter()))
        f = lambda x, y: (x - y) ** 2 // y
        for s in sources:
            put(lang, s, "pair", [(o, sum(f(p[s][t], p[o][t]) for t in kept)) for o in sources if o != s])
            put(lang, s, "term", [(t, f(p[s][t], q[t])) for t in kept if counts[lang, s][t] and p[s][t] > q[t]], top)
    return sorted(out)


def test_source_divergence(spark):
    r = random.Random(12)
    texts = edge_texts() + prose(91, 60, words=150) + ["Éa éa ÉA'b tie1tie2 ÀÇ", "tie one", "tie two", "rare 漢字", "the " * 5000] * 3
    rows = [(t, r.choice(["en", "en", "de", "", None]), r.choice(["a", "b", "c", "é", "z", None])) for t in texts]
    rows += [(None, "empty", "x"), ("", "empty", "y"), ("once", "few", "one"), (rows[60][0], "alone", "single")] + [rows[50]] * 2
    rows += [("same words here", "tied", s) for s in "pqrs"]
    docs = rows_of(spark, [(None, t, lang, source, 0) for t, lang, source in rows])
    docs = docs.select("*", *[F.lit(1).alias(c) for c in ("term", "n", "total", "v", "p", "q", "p0", "item", "value", "rank")])
    got = sorted(tuple(x) for x in source_divergence.audit(docs).collect())
    assert got == divergence_truth(rows)
    assert {x[4] for x in got if x[0] == "empty"} == {0}
    assert source_divergence.audit(empty_documents(spark)).count() == 0


def test_divergence_in_small_parts(spark, monkeypatch):
    """Tables emptied often, many blocks, ranks cut."""
    rows = [(t, "en", f"s{k % 7}") for k, t in enumerate(prose(92, 50, words=300))]
    docs = rows_of(spark, [(k, t, lang, s, 0) for k, (t, lang, s) in enumerate(rows)])
    monkeypatch.setattr(source_divergence, "BLOCK_ROWS", 50)
    got = sorted(tuple(x) for x in source_divergence.audit(docs, top_terms=5).collect())
    assert got == divergence_truth(rows, top=5)


def test_joint_cells_and_sums(monkeypatch):
    r = np.random.default_rng(4)
    terms, sources = 150, 6
    n = r.integers(0, 4, (terms, sources))
    bit, source = np.nonzero(n)
    first, bitsets = source_divergence.level_bitsets(bit, source, n[bit, source])
    monkeypatch.setattr(source_divergence, "CELLS", 7)
    cells = {}
    for i, j, c in source_divergence.joint_cells(bitsets, source[first]):
        level = lambda k: (int(source[first[k]]), int(n[bit[first[k]], source[first[k]]]))
        cells.update({(level(a), level(b)): int(x) for a, b, x in zip(i, j, c, strict=True)})
    truth = Counter(((a, int(row[a])), (b, int(row[b]))) for row in n for a in range(sources) for b in range(sources) if a != b and row[a] and row[b])
    assert cells == truth
    monkeypatch.setattr(source_divergence, "PAIR_SUMS", 3)
    sums = source_divergence.PairSums()
    values = [(a, b, int(v)) for a in range(3) for b in range(3) for v in (2**61, -(2**62), 17, 2**62)]
    for a, b, v in values:
        sums.add(np.array([a]), np.array([b]), np.array([v]), np.array([60]))
    pair, high, low = sums.summed()
    assert {(int(k) >> 32, int(k) & 0xFFFFFFFF): (int(h) << 32) + int(x) for k, h, x in zip(pair, high, low, strict=True)} == {
        (a, b): 60 * (2**61 + 17) for a in range(3) for b in range(3)}


def test_audit_queries_read_whole_tables(spark):
    assert QUERIES["op11_filter_audit"](spark, SF).groupBy("part").count().where("count <> 600").count() == 0
    pairs = QUERIES["op13_source_divergence"](spark, SF).where("part = 'pair'")
    assert pairs.groupBy("lang", "source").agg(F.max("rank").alias("r"), F.count("*").alias("n")).where("r <> n").count() == 0
