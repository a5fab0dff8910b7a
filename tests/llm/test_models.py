"""BPE, token counts, language identification and quality grades."""

import hashlib
import json
import math
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from llm_cases import TEXTS, by_id

from revcast.llm import bpe, langid, quality, tokencounts
from revcast.llm.text import utf8

SF = "/root/testdata/sf0.001"


# --- BPE -----------------------------------------------------------------

@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.no_padding()
    t.no_truncation()
    return t


def same_as_library(library, texts):
    v = bpe.load(None)
    ids, first = bpe.encode_texts(v, pa.array(texts, pa.string()))
    decoded = bpe.decode_ids(v, ids, first)
    for n, t in enumerate(texts):
        want = library.encode(t or "", add_special_tokens=False).ids
        assert ids[first[n]:first[n + 1]].tolist() == want, t
        assert decoded[n].decode() == library.decode(want, skip_special_tokens=False), t


def test_encodes_as_the_library(library):
    same_as_library(library, TEXTS)
    same_as_library(library, ["don't 'tis ''s 's 'S 'll'd '\n's", "x<|endoftext|>y <|endoftext|> ", "$$$ &&&& ----- ''''",
                              "1²½Ⅷ", "\x1c\x1d \x1e", "\r\n\r\n x", "İß ẞ", "<|endoftext", "<<|endoftext|>|>", " the" * 300,
                              "ab" * 1000, "👩‍💻 👨‍👩‍👧", "\u1c89\U0001e5f1\U00016d40"])
    rng = random.Random(3)
    letters = "aab'sstredlmv  \n\t.,!12é日\u00a0\u2003<|>endoftext-_'’"
    texts = ["".join(rng.choices(letters, k=rng.randrange(60))) for _ in range(1500)]
    texts += ["".join(chr(rng.choice([rng.randrange(32, 0x250), rng.randrange(0x370, 0x3000), rng.randrange(0x1F300, 0x1F700),
                                      32])) for _ in range(rng.randrange(40))) for _ in range(500)]
    same_as_library(library, texts)


def test_prefix_dp_equals_replayed_merges():
    """A small vocabulary whose merges compete; some tokens are never made."""
    merges = ["a b", "b a", "ab a", "a a", "aa a", "ab ab", "b b", "ba b", "aa b", "aab b", "bb bb", "aba aba"]
    letters = {b: c for c, b in bpe.byte_letters().items()}
    vocab = {letters[b]: b for b in range(256)}
    ranks = {}
    for n, m in enumerate(merges):
        x, y = m.split(" ")
        if x in vocab and y in vocab:
            vocab.setdefault(x + y, len(vocab))
            ranks[x, y] = n
    v = bpe.read_vocabulary(json.dumps({"model": {"vocab": vocab, "merges": [list(k) for k in ranks]}, "added_tokens": []}))

    def replay(text):
        parts = list(text)
        while True:
            found = [(ranks[p], i) for i, p in enumerate(zip(parts, parts[1:], strict=False)) if p in ranks]
            if not found:
                return [vocab[p] for p in parts]
            _, i = min(found)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]

    rng = random.Random(4)
    for _ in range(3000):
        t = "".join(rng.choices("ab", k=rng.randrange(1, 14)))
        assert bpe.encode_piece(v, t.encode()) == replay(t), t


def test_pieces_share_the_work_on_prefixes():
    v = bpe.load(None)
    rng = random.Random(5)
    pieces = sorted({" " + "".join(rng.choices("abé日", k=rng.randrange(0, 9))) for _ in range(600)} | {"", "a" * 300})
    data = [p.encode() for p in sorted(pieces, key=str.encode)]
    alone = [bpe.encode_piece(v, d) for d in data]
    read = []

    class Counted(list):
        def __getitem__(self, i):
            read.append(i)
            return list.__getitem__(self, i)

    whole, v.longest = v.longest, Counted(v.longest)
    try:
        assert bpe.encode_pieces(v, data) == alone
        steps = len(read)
        assert bpe.encode_pieces(v, data[::-1]) == alone[::-1]
    finally:
        v.longest = whole
    assert steps < 0.7 * sum(len(d) for d in data)
    assert bpe._encode_cached(v, [*data, *data]) == alone + alone


def test_round_trip_report(library, edge_docs, no_docs):
    got = by_id(bpe.round_trip(edge_docs))
    for i, t in enumerate(TEXTS):
        ids = library.encode(t or "", add_special_tokens=False).ids
        assert got[i]["n_tokens"] == len(ids)
        assert got[i]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256(
            library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    back = by_id(bpe.decode(bpe.encode(edge_docs)))
    assert all(back[i]["text"] == (t or "") for i, t in enumerate(TEXTS))
    rows = bpe.encode_rows(edge_docs)
    assert rows.count() == len(TEXTS) + 1 and "text" not in rows.columns and rows.columns[-2:] == ["n_tokens", "ids"]
    assert bpe.round_trip(no_docs).count() == 0


# --- token counts --------------------------------------------------------

def plain_attribution(v, text, parts):
    """Most bytes; of equal shares the first part."""
    ids, _ = bpe.encode_texts(v, pa.array([text]))
    sizes = [len(p.encode()) for p in parts]
    edges = [sum(sizes[:k]) for k in range(len(sizes) + 1)]
    counts, crossing, at = [0] * len(parts), 0, 0
    for i in ids:
        end = at + len(v.tokens[i])
        held = [max(0, min(end, edges[k + 1]) - max(at, edges[k])) for k in range(len(parts))]
        counts[held.index(max(held))] += 1
        crossing += sum(h > 0 for h in held) > 1
        at = end
    return counts, crossing


def lines_of(text):
    lines = text.split("\n")
    return [x + "\n" for x in lines[:-1]] + lines[-1:]


def test_line_counts(spark, no_docs):
    v = bpe.load(None)
    texts = ["a\n\n\n\nb", "", None, "x\n", "é\n日本\n\n  z", "\n", "\r\n\r\n\n\n x\n\n"] + TEXTS[8:-1]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, counts string")
    got = by_id(tokencounts.line_counts(docs))
    for i, t in enumerate(texts):
        counts, crossing = plain_attribution(v, t or "", lines_of(t or ""))
        assert (got[i]["counts"], got[i]["n_crossing"]) == (counts, crossing), t
        assert sum(counts) == got[i]["n_tokens"]
    assert tokencounts.line_report(no_docs).count() == 0


def test_field_counts_cross_boundaries(spark):
    v = bpe.load(None)
    rows = [(1, "user", "hello wor", "ld again"), (2, None, "", "é"), (3, "a", None, None)]
    df = spark.createDataFrame(rows, "id long, role string, x string, y string")
    for separator in ("\n", ""):
        got = by_id(tokencounts.field_counts(df, "id", ["role", "x", "y"], separator), "id")
        for i, *fields in rows:
            parts = [(f or "") + separator for f in fields[:-1]] + [fields[-1] or ""]
            counts, crossing = plain_attribution(v, "".join(parts), parts)
            assert (got[i]["counts"], got[i]["n_crossing"]) == (counts, crossing)


# --- languages -----------------------------------------------------------

def plain_ppm(text, counts):
    folded = bytearray()
    for b in langid._FOLD[np.frombuffer(text.encode(), np.uint8)].tolist():
        if b != 0x20 or not folded or folded[-1] != 0x20:
            folded.append(b)
    s = b" " * langid.ORDER + bytes(folded)
    seen = {n: dict(zip(g.tolist(), c.tolist(), strict=True)) for n, (g, c) in counts.items()}
    total, kinds = defaultdict(int), defaultdict(int)
    for n in seen:
        for g, c in seen[n].items():
            total[n, g >> 8] += c
            kinds[n, g >> 8] += 1
    bits = 0.0
    for i in range(langid.ORDER, len(s)):
        for n in range(langid.ORDER + 1, -1, -1):
            if not n:
                bits += 8
                break
            g = int.from_bytes(s[i - n + 1:i + 1], "big")
            t, k = total[n, g >> 8], kinds[n, g >> 8]
            if g in seen[n]:
                bits += math.log2((t + k) / seen[n][g])
                break
            bits += math.log2((t + k) / k) if k else 0
    return bits


def test_code_lengths_are_exact_ppm():
    samples = {"en": ["the old river bank", "of the house"], "de": ["der alte Fluß und das Haus"], "fr": ["la maison été"]}
    counts = {x: langid.count_grams(*utf8(pa.array(t))) for x, t in samples.items()}
    model = langid.build_model(counts)
    texts = ["the river", "das Haus été", "日本 qqq zz", "x", "", " !! the", "a" * 50]
    bits, _ = model.code_lengths(*utf8(pa.array(texts)))
    model.place = None  # the same without the dense tables
    again, _ = model.code_lengths(*utf8(pa.array(texts)))
    for n, t in enumerate(texts):
        for k, x in enumerate(model.languages):
            assert bits[n, k] == pytest.approx(plain_ppm(t, counts[x]), abs=1e-3)
    assert np.allclose(bits, again)


def test_language_report_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = by_id(langid.language_report(docs))
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    assert set(got) == set(truth)
    for i, r in got.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= r["score"] <= 1
    held = [i for i, r in got.items() if r["held_out"]]
    assert np.mean([got[i]["lang_pred"] == truth[i] for i in held]) >= 0.97
    assert sum(r["lang_pred"] == "und" for r in got.values()) == 0


def test_language_edge_cases(spark, edge_docs, no_docs):
    got = by_id(langid.language_report(edge_docs))
    for i, t in enumerate(TEXTS):
        known = any(c.isalpha() for c in t or "")
        assert (got[i]["lang_pred"] in ("en", "fr")) == known
        assert known or (got[i]["lang_pred"], got[i]["score"]) == ("und", 0)
    assert langid.language_report(no_docs).count() == 0
    unlabelled = edge_docs.selectExpr("doc_id", "text", "cast(null as string) as lang")
    assert {r.lang_pred for r in langid.language_report(unlabelled).collect()} == {"und"}


# --- quality -------------------------------------------------------------

def test_grader_orders_held_out_grades():
    rng = random.Random(6)
    words = [f"w{i}" for i in range(300)]
    texts, grades = [], []
    for n in range(900):
        w = rng.choices(words, k=rng.randrange(20, 80))
        grade = n % 3
        w += rng.sample(["idiot", "scum", "moron"], 2) if grade < 2 else []
        texts.append((" %%% " if grade == 0 else " ").join(w))
        grades.append(grade)
    number, first = quality.text_features(pa.array(texts))
    cut = 600
    g = quality.train(number[:first[cut]], first[:cut + 1], np.array(grades[:cut]))
    assert (np.diff(g.limits) > 0).all()
    f = g.score(number[first[cut]:], first[cut:] - first[cut])
    tails = g.tails(f)
    assert ((tails > 0.5).sum(axis=1) == np.array(grades[cut:])).mean() > 0.95
    assert (np.diff(tails, axis=1) <= 0).all()


def test_quality_query_on_ratings(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    rated = labels.where("doc_id % 2 = 0")  # learn from half of the ratings, judge by the others
    got = by_id(quality.grade_documents(docs, rated))
    assert len(got) == docs.count()
    other = labels.where("doc_id % 2 = 1").collect()
    clean = [got[r.doc_id]["kept"] for r in other if r.quality == 1 and r.toxic == 0]
    bad = [got[r.doc_id]["kept"] for r in other if r.quality == 0 or r.toxic == 1]
    assert np.mean(clean) > 0.95 and np.mean(bad) < 0.25


def test_quality_edge_cases(spark, edge_docs, no_docs):
    schema = "doc_id long, quality int, toxic int"
    none = spark.createDataFrame([], schema)
    got = by_id(quality.grade_documents(edge_docs, none))
    assert len(got) == len(TEXTS) and all(r["kept"] and 0 <= r["expected_grade"] <= 2 for r in got.values())
    some = spark.createDataFrame([(12, 1, 0), (12, 1, 0), (None, 1, 1), (13, None, 0), (10, 0, 1), (99, 1, 0)], schema)
    assert len(by_id(quality.grade_documents(edge_docs, some))) == len(TEXTS)
    assert quality.grade_documents(no_docs, some).count() == 0
    assert not re.search("nan", str(got))
