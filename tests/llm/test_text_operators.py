"""Token counts, BPE, quality rules, language ID, licences against brute force."""

import hashlib
import random
import re
import zlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from payscope.llm import byte_bpe, language_id, license_scan, quality_rules, token_counts
from payscope.llm.licence_texts import LICENCE_TEXTS
from payscope.llm.queries import BYTE_BPE_RANKS, QUERIES
from payscope.llm.tokens import encoding, load_ranks
from tests.llm.fixtures import documents, edge_texts, empty_documents

SF = "/root/testdata/sf0.001"


def greedy(word: bytes, pieces: set) -> int:
    n = at = 0
    while at < len(word):
        cut = next((k for k in range(len(word), at, -1) if word[at:k] in pieces), None)
        if cut is None:
            return -1
        n, at = n + 1, cut
    return n


def test_longest_match_is_greedy():
    r = random.Random(3)
    for _ in range(60):
        pieces = {bytes(r.choices(b"abc", k=r.randint(1, 5))) for _ in range(r.randint(1, 14))}
        machine = token_counts.LongestMatch(pieces)
        for _ in range(60):
            word = bytes(r.choices(b"abc", k=r.randint(0, 12)))
            assert machine.count(word) == greedy(word, pieces), (word, pieces)


def test_token_counts_of_edge_texts(spark):
    pieces = set(load_ranks(BYTE_BPE_RANKS))
    rows = {x.doc_id: x for x in token_counts.token_counts(documents(spark, extra=True), BYTE_BPE_RANKS).collect()}
    for k, t in enumerate(edge_texts()):
        words = (t or "").split()
        assert (rows[k].n_words, rows[k].n_unknown) == (len(words), 0)
        if len(t or "") < 2000:
            assert rows[k].n_tokens == sum(greedy(b" " + w.encode(), pieces) for w in words)
    assert token_counts.token_counts(empty_documents(spark), BYTE_BPE_RANKS).count() == 0


def test_unknown_words():
    machine = token_counts.LongestMatch([b" a", b"b", b"bc"])
    assert token_counts.count_text("ab abc xyz a", machine, {}) == (4, 2 + 2 + 1 + 1, 1)
    assert token_counts.count_text("ab ab", machine, {}, max_words=0) == (2, 4, 0)


def test_bpe_equals_tiktoken(spark):
    own = encoding(BYTE_BPE_RANKS)
    r = random.Random(5)
    alphabet = [*"ab '\n\t ,.1s\u00a0\x1c\x85éß\r!<|", "'s", "'ll", " \n", "  ", "hello", "<|endoftext|>", "\u200b", "漢字", "😀"]
    texts = edge_texts() + ["".join(r.choices(alphabet, k=r.randint(0, 25))) for _ in range(400)]
    texts += ["a" * 3000, "aab" * 900, "".join(r.choices("abcdefgh", k=800))]
    df = byte_bpe.encode(documents(spark, texts, extra=True), BYTE_BPE_RANKS, group_bytes=4000)
    rows = {x.doc_id: x for x in df.select("*", byte_bpe.ids_array(df["ids"]).alias("numbers")).collect()}
    assert len(rows) == len(texts)
    for k, t in enumerate(texts):
        want = own.encode_ordinary(t or "")
        assert rows[k].numbers == want and rows[k].n_tokens == len(want), t
        assert bytes(rows[k].decoded) == (t or "").encode()
    assert byte_bpe.encode(empty_documents(spark), BYTE_BPE_RANKS).count() == 0


def test_bpe_query(spark):
    own = encoding(BYTE_BPE_RANKS)
    texts = {x.doc_id: x.text for x in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op6_byte_bpe"](spark, SF).collect()
    assert sorted(x.doc_id for x in rows) == sorted(texts)
    for x in rows:
        ids = own.encode_ordinary(texts[x.doc_id])
        assert x.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert x.decoded_sha256 == hashlib.sha256(texts[x.doc_id].encode()).hexdigest()


def measured(text: str) -> tuple:
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    covered = {p for i, w in enumerate(windows) if windows.count(w) > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def test_quality_measures_by_brute_force():
    r = random.Random(7)
    for _ in range(300):
        text = "".join(r.choices(["a", "b", "c", " ", "  ", "\n", "\t", "\x1c", "\u00a0", "é", "#", "|", "!!"], k=r.randint(0, 60)))
        assert quality_rules.measure_text(text)[:5] == measured(text), text


def test_quality_ledger_and_policies(spark):
    texts = edge_texts() + ["spam eggs ham " * 40, "one # " * 60, " ".join(f"w{k}!!" for k in range(90)), "\n".join(["same line here"] * 30)]
    ledger = quality_rules.measure(documents(spark, texts, extra=True))
    rows = {x.doc_id: x for x in quality_rules.apply_policy(ledger, "web-2").collect()}
    bits = {r.name: 1 << r.bit for r in quality_rules.rules()}
    for k, t in enumerate(texts):
        if len(t or "") < 2500:
            assert (rows[k].n_words, rows[k].word_chars, rows[k].n_symbols, rows[k].n_dup_lines, rows[k].n_repeat_words) == measured(t or "")
        assert rows[k].kept == (rows[k].fail_bits & quality_rules.mask(quality_rules.POLICIES["web-2"]) == 0)
        assert rows[k].n_blocks == max(1, rows[k].n_words // 1000) and rows[k].n_dull_blocks <= rows[k].n_blocks
    n = len(texts)
    assert rows[n - 4].fail_bits & bits["repeated_windows"] and rows[n - 3].fail_bits & bits["symbols"]
    assert rows[n - 2].fail_bits & bits["shouting"] and rows[n - 1].fail_bits & bits["duplicate_lines"]
    kept = documents(spark, texts).where(quality_rules.passes(F.col("text"), "web-2"))
    assert {x.doc_id for x in kept.collect()} == {k for k, x in rows.items() if x.kept}
    found = {x.rule: x for x in quality_rules.ablations(ledger, "web-2").collect()}
    whole = quality_rules.mask(quality_rules.POLICIES["web-2"])
    for name in quality_rules.POLICIES["web-2"]:
        assert found[name].n_failed == sum(bool(x.fail_bits & bits[name]) for x in rows.values())
        assert found[name].n_only == sum(x.fail_bits & whole == bits[name] for x in rows.values())
        assert found[name].n_kept_without == sum(x.fail_bits & whole & ~bits[name] == 0 for x in rows.values())
    assert quality_rules.measure(empty_documents(spark)).count() == 0


def test_dull_texts_of_any_length(spark):
    r = random.Random(31)
    few = [f"w{k}" for k in range(60)]
    dull = [" ".join(r.choices(few, k=n)) for n in (900, 1999, 2000, 5000, 30_000)]
    fresh = [" ".join(r.choice(few) if r.random() < 0.5 else f"x{r.randrange(10**6)}" for _ in range(n)) for n in (60, 900, 1999, 5000, 30_000)]
    half = " ".join(dull[3].split()[:2000] + fresh[3].split()[:2500])  # two dull blocks of four
    ledger = quality_rules.measure(documents(spark, dull + fresh + [half, dull[0][:100]]))
    bit = {x.name: 1 << x.bit for x in quality_rules.rules()}["dull_blocks"]
    assert [bool(x.fail_bits & bit) for x in ledger.orderBy("doc_id").collect()] == [True] * 5 + [False] * 7
    blocks = [(x.n_blocks, x.n_dull_blocks) for x in ledger.orderBy("doc_id").collect()]
    assert blocks[:5] == [(1, 1), (1, 1), (2, 2), (5, 5), (30, 30)] and blocks[10] == (4, 2)


def test_more_languages_than_bits_of_a_word(spark):
    r = random.Random(37)
    letters = [chr(c) for c in range(ord("a"), ord("z") + 1)]
    vocabulary = {f"l{k:03d}": ["".join(r.choices(letters, k=6)) for _ in range(40)] for k in range(70)}
    rows = [(" ".join(r.choices(words, k=60)), lang) for lang, words in vocabulary.items() for _ in range(3)]
    model = language_id.train(spark.createDataFrame(rows, "text string, lang string"))
    assert model.slots.shape[0] == 2 and len(model.languages) == 70
    fp = model.false_positives()
    held = [(lang, model.predict(" ".join(r.choices(words, k=30)), fp)[0]) for lang, words in vocabulary.items()]
    assert sum(a == b for a, b in held) >= 69


def test_long_text_takes_several_blocks(spark, monkeypatch):
    rows = [("aber das ist nicht so gut wie es war " * 20, "de"), ("but this is not as good as it was then " * 20, "en")]
    model = language_id.train(spark.createDataFrame(rows, "text string, lang string"))
    fp = model.false_positives()
    text = "das war gut und ist es nicht aber so " * 50
    whole = model.predict(text, fp)
    monkeypatch.setattr(language_id, "BLOCK", 100)
    assert model.predict(text, fp) == whole and whole[0] == "de"


def test_language_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    lang = {x.doc_id: x.lang for x in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = QUERIES["op8_language_id"](spark, sf).collect()
    assert len(rows) == len(lang)
    assert all(x.held_out == (zlib.crc32(str(x.doc_id).encode()) % 4 == 2) for x in rows)
    held = [x for x in rows if x.held_out and lang[x.doc_id]]
    assert sum(x.lang_pred == lang[x.doc_id] for x in held) >= 0.97 * len(held)
    assert all(0 <= x.score <= 1 for x in rows)


def test_language_edges(spark):
    docs = documents(spark, extra=True)
    model = language_id.train_on_documents(docs)
    got = {x.doc_id: x for x in docs.select("doc_id", language_id.predictor(model)(docs["text"]).alias("p")).select("doc_id", "p.*").collect()}
    for k, t in enumerate(edge_texts()):
        if not re.search(r"[^\W\d_]", t or ""):
            assert (got[k].lang_pred, got[k].score) == ("und", 0.0)
    nothing = language_id.train_on_documents(empty_documents(spark))
    assert nothing.languages == () and nothing.predict("some text", nothing.false_positives()) == ("und", 0.0)


def test_every_labelled_language_is_learnt(spark):
    r = random.Random(21)
    word = lambda letters: "".join(r.choices(letters, k=4))
    said = {f"l{k}": "abcdefghijklmnopqrstuvwx"[3 * k:3 * k + 3] for k in range(8)}
    long = [(name, " ".join(word(letters) for _ in range(40_000))) for name, letters in said.items()]
    copied = [(name, t) for name, t in (("copied", " ".join(word("yzä") for _ in range(100))),) for _ in range(2000)]
    model = language_id.train(spark.createDataFrame(long + copied, "lang string, text string"), max_train_chars=20_000)
    fp = model.false_positives()
    for name, letters in [*said.items(), ("copied", "yzä")]:
        assert model.predict(" ".join(word(letters) for _ in range(50)), fp)[0] == name


def test_bit_sliced_filters_find_every_learned_ngram(spark):
    docs = spark.createDataFrame([(k, t, "aa" if k % 2 else "bb") for k, t in enumerate(["abcd efgh", "ijkl mnop"] * 3)], "doc_id long, text string, lang string")
    model = language_id.train(docs)
    for text, name in (("abcd efgh", "bb"), ("ijkl mnop", "aa")):
        bit = 1 << model.languages.index(name)
        assert (model.masks(language_id.ngrams(text)) & bit == bit).all()
        assert model.predict(text, model.false_positives())[0] == name


@pytest.mark.parametrize("dress", [str, str.upper, lambda t: "Copyright (c) 2001 Some One\n\n" + t, lambda t: t.replace("license", "licence"),
                                   lambda t: "\u00a9 1999-2003 Them, Inc. All rights reserved.\n" + t.replace("\n", "\r\n"), lambda t: t.replace(" ", "  ").replace('"', "``")])
def test_licences_in_other_dress(spark, dress):
    texts = [dress(t) for _, t in LICENCE_TEXTS]
    rows = {x.doc_id: x for x in license_scan.scan(documents(spark, texts, extra=True), license_scan.known_licences(spark)).collect()}
    for k, (name, _) in enumerate(LICENCE_TEXTS):
        assert rows[k].text_licence == name and name in rows[k].licences.split(",")


def test_licences_of_several_paragraphs_inside_documents(spark):
    several = [(name, t) for name, t in LICENCE_TEXTS if t.count("\n\n") >= 1 and not t.startswith(("MIT License", "ISC License"))]
    texts = [f"A title\n\nCopyright 2020 Some One\n\n{t.upper()}\n\n\nimport os\n\ndef main():\n    pass\n" for _, t in several]
    mit = dict(several)["MIT"].split("\n\n")
    broken = ["\n\n".join([mit[0], "something else between", *mit[1:]]), "\n\n".join(mit[::-1]), mit[0], "\n\n".join(mit[:-1]), "\n\n".join([mit[0], mit[0], mit[-1]])]
    twice = "\n\n".join([*mit, "code", *mit, mit[0]])
    rows = {x.doc_id: x for x in license_scan.scan(documents(spark, [*texts, *broken, twice], extra=True), license_scan.known_licences(spark)).collect()}
    for k, (name, _) in enumerate(several):
        assert (rows[k].text_licence, rows[k].licences) == (None, name)
    assert {name for name, _ in several} >= {"MIT", "ISC", "0BSD", "BSD-2-Clause", "BSD-3-Clause"}
    n = len(texts)
    assert [rows[n + k].licences for k in range(len(broken))] == [""] * len(broken)
    assert (rows[n + len(broken)].text_licence, rows[n + len(broken)].licences) == (None, "MIT")


def test_licence_notices_and_edges(spark):
    texts = [*edge_texts(), "some words\nReleased under the MIT Licence\nmore", "not released under the mit license at all", "a\n\nlicensed under the apache license, version 2.0\n"]
    rows = {x.doc_id: x for x in license_scan.scan(documents(spark, texts), license_scan.known_licences(spark)).collect()}
    n = len(texts)
    assert (rows[n - 3].text_licence, rows[n - 3].licences) == (None, "MIT")
    assert rows[n - 2].licences == "" and rows[n - 1].licences == "Apache-2.0"
    assert all(rows[k].licences == "" for k in range(n - 3))
    assert license_scan.scan(empty_documents(spark), license_scan.known_licences(spark)).count() == 0


def test_vocabulary_files_agree():
    assert load_ranks(public_tokenizers.path("byte_bpe_50k.json")) == load_ranks(BYTE_BPE_RANKS)
