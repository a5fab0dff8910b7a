"""License, secret and contamination scans against brute force."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
from llm_cases import LONG, TEXTS, by_id, lower, words

from revcast.llm import decontam, licenses, secrets
from revcast.llm.license_texts import BASE_PHRASES, TEMPLATES
from revcast.llm.text import LOWER, span_hashes, utf8, word_spans


# --- licenses ------------------------------------------------------------

def notice_words():
    return [words(t) for t, _ in BASE_PHRASES] + [words(t) for _, t in TEMPLATES]


def test_matching_statistics_are_longest_factors():
    rng = random.Random(1)
    sequences = notice_words()
    factors = {tuple(s[i:j]) for s in sequences for i in range(len(s)) for j in range(i + 1, len(s) + 1)}
    texts = []
    for _ in range(60):
        w = []
        while len(w) < 80:
            s = rng.choice(sequences)
            i = rng.randrange(len(s))
            w += s[i:i + rng.randrange(1, 20)] + ["zzz"] * (rng.random() < 0.3)
        texts.append(" ".join(w))
    data, offsets = utf8(pa.array(texts))
    low = LOWER[data]
    starts, ends, first = word_spans(low, offsets)
    length, _ = licenses.matching_statistics(licenses.build_automaton(), span_hashes(low, starts, ends), first)
    for row, t in enumerate(texts):
        w = words(t)
        for i in range(len(w)):
            n = 0
            while n <= i and tuple(w[i - n:i + 1]) in factors:
                n += 1
            assert n == length[first[row] + i]


def test_license_report_base_columns(edge_docs):
    got = by_id(licenses.license_report(edge_docs))
    for i, t in enumerate(TEXTS):
        w = words(t)
        places = [(k, label) for p, label in BASE_PHRASES for k in range(len(w)) if w[k:k + len(p.split())] == p.split()]
        r = got[i]
        assert (r["n_words"], r["n_base"]) == (len(w), len(places))
        assert r["first_word"] == (min(places)[0] if places else None)
        assert r["last_word"] == (max(places)[0] if places else None)
        assert r["base_labels"] == ",".join(sorted({x for _, x in places}))
        assert set(filter(None, r["base_labels"].split(","))) <= set(filter(None, r["labels"].split(",")))
        assert 0 <= r["score"] <= 1


def test_notices_are_chained_over_small_edits():
    auto = licenses.build_automaton()
    mit = dict(TEMPLATES[:2])["mit"]
    changed = mit.replace("associated documentation", "related documentation").replace("without restriction", "without any limits")
    found = licenses.scan(auto, pa.array(["intro words " + changed + " tail", mit[:60], None]))
    label, start, end, cover = max(found[0]["notices"], key=lambda x: x[3])
    assert label == "mit" and start >= 2 and cover > 0.8 and end <= len(words(changed)) + 2
    assert found[1]["notices"] == [] and found[2] == {"n_words": 0, "phrases": [], "notices": []}


def test_single_word_phrases_and_repeats():
    auto = licenses.build_automaton((("copyleft", "cl"), ("mit license", "mit")), ())
    found = licenses.scan(auto, pa.array(["copyleft mit license copyleft copyleft"]))[0]
    assert sorted(found["phrases"]) == [("cl", 0, 1), ("cl", 3, 4), ("cl", 4, 5), ("mit", 1, 3)]


# --- secrets -------------------------------------------------------------

def plain_spans(t):
    out = []
    keyword = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w)
                       for w in ("password", "passwd", "secret", "token", "api_?key"))
    for m in re.finditer(rf"({keyword})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", t):
        if len(m[2]) >= 6:
            out.append((m.start(), 0, m.end()))
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
    return sorted(out)


HARD = ["toKEN==abcdefg", "password: short", "passwd='A.b-c_d=e'", "api_key = x1y2z3; APIKEY:qwerty1",
        "toKen=abcdefg ſecret=abcdefg", "éé token = \"" + "ab12" * 10 + "\"", "AKIA" + "A" * 15, "AKIA" + "B" * 16,
        "secret=abc secret=abcdef", "f" * 23 + " " + "e" * 24, "token=\n abcdefgh", "password=abc password=abcdefgh"]


def test_base_spans():
    for t in HARD + [x for x in TEXTS if x]:
        want = plain_spans(t)
        got = [(a, secrets.KINDS.index(k), b) for k, a, b in secrets.base_spans(t)]
        assert got == want, t


def test_secret_report(spark, edge_docs, no_docs):
    net = secrets.fit_network(edge_docs)
    got = by_id(secrets.secret_report(edge_docs, network=net))
    for i, t in enumerate(TEXTS):
        want = plain_spans(t or "")
        text = ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in want)
        r = got[i]
        assert r["base_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(k == n for _, k, _ in want) for n in range(3)]
        assert set(filter(None, text.split(","))) <= set(filter(None, r["spans"].split(",")))
    clean = by_id(secrets.redact(edge_docs, network=net))
    assert "0641917ea4" not in clean[11]["text"] and "AKIAMD" not in clean[11]["text"] and clean[0]["text"] is None
    assert clean[12]["text"] == TEXTS[12] and clean[12]["n_words"] == "clash"
    assert secrets.secret_report(no_docs).count() == 0  # trains on the drawn values alone


def test_network_finds_what_the_patterns_miss_and_spares_plain_runs():
    plain = [("see the ", w, " there") for w in ("house", "river", "Gemeinde", "casa", "ciudad", "maison")]
    found = [("token = \"", "0641917ea4e9feb9cda83477b57ac265", "\" and")]
    x, more, y, shapes = secrets.examples(found, plain, n=1500)
    held = np.arange(len(x)) % 6 < 2
    net = secrets.calibrate(secrets.train(x[~held], more[~held], y[~held]), x[held], more[held], y[held], shapes[held])
    scores = net.scores(x[held], more[held])
    for k in range(secrets.SHAPES):  # recall-constrained
        good = (y[held] == 1) & (shapes[held] == k)
        assert (scores[good] >= net.thresholds[k]).mean() >= 0.9
    assert (scores[y[held] == 0] >= 0.5).mean() < 0.05
    spans = secrets.find_spans(net, ["my key is ghp_A1b2C3d4E5f6G7h8I9j0K1l2M3n4 ok", "river-house-123 was 2024-05-06T07"])
    assert [s[0] for s in spans[0]] == ["model"] and spans[1] == []


def test_thresholds_keep_the_recall_of_positives_that_look_plain():
    rng = np.random.default_rng(3)
    words = [f"{a}{b}" for a in ("river", "house", "stone", "light") for b in ("field", "yard", "work")]
    found = [("password=", w + "1", " x") for w in words]  # assigned values like words: scores under a half
    plain = [("the ", w, " is") for w in words]
    x, more, y, shapes = secrets.examples(found, plain, n=600)
    net = secrets.calibrate(secrets.train(x, more, y, epochs=1), x, more, y, shapes)
    net.dense = rng.normal(0, 0.2, net.dense.shape).astype(np.float32)  # a poor network
    net = secrets.calibrate(net, x, more, y, shapes)
    scores = net.scores(x, more)
    for k in range(secrets.SHAPES):
        good, bad = (scores[(y == label) & (shapes == k)] for label in (1, 0))
        assert (good >= net.thresholds[k]).mean() >= secrets.RECALL
        assert net.false_positives[k] == ((bad >= net.thresholds[k]).mean() if len(bad) else None)
    assert min(net.thresholds) < 0.5


def test_drawn_positives_begin_at_the_least_candidate(monkeypatch):
    sizes = []
    window = secrets.window
    monkeypatch.setattr(secrets, "window", lambda t, a, b: sizes.append(b - a) or window(t, a, b))
    _, _, y, _ = secrets.examples([], [], n=1000)
    assert min(n for n, label in zip(sizes, y, strict=True) if label) == secrets.MIN_RUN


def test_network_learns_from_every_document_however_dealt(spark, monkeypatch):
    """No sample: each document's examples count, and rows' order and partitions don't matter."""
    monkeypatch.setattr(secrets, "ROUNDS", 1)
    texts = [f"word{i} river token = \"{hashlib.md5(str(i).encode()).hexdigest()}\" and house{i} more" for i in range(6100)]
    texts += [texts[0], None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    made = secrets.corpus_examples(docs, "text").toPandas()
    assert made["n"].sum() == sum(len(secrets.labelled(t)) for t in texts if t)
    assert 0.3 < made[made["held"]]["n"].sum() / made["n"].sum() < 0.37
    nets = [secrets.fit_network(d) for d in (docs, docs.orderBy("text").repartition(7, "doc_id"))]
    assert all((getattr(nets[0], k) == getattr(nets[1], k)).all() for k in ("taps", "bias", "dense"))
    assert nets[0].thresholds == nets[1].thresholds and (nets[0].scale, nets[0].shift) == (nets[1].scale, nets[1].shift)
    spans = secrets.find_spans(nets[0], ["my key is ghp_A1b2C3d4E5f6G7h8I9j0K1l2M3n4 ok", "river-house-123 was 2024-05-06T07"])
    assert [s[0] for s in spans[0]] == ["model"] and spans[1] == []


# --- decontamination -----------------------------------------------------

ITEMS = [("b2", "One two three four five six seven eight nine ten eleven twelve"), ("b10", "quick Brown FOX"),
         ("b1", "quick brown fox"), ("null", None), ("empty", " .. "), ("b2", "over the lazy dog"),
         ("é1", "日本語 テキスト"), ("long", " ".join(f"word{i % 977} the of" for i in range(50, 60)))]


def plain_hits(t, items):
    w, hit, found = words(t), set(), set()
    for name, text in items:
        x = words(text)
        m = min(10, len(x))
        for k in range(len(x) - m + 1) if m else []:
            for i in range(len(w) - m + 1):
                if w[i:i + m] == x[k:k + m]:
                    hit |= set(range(i, i + m))
                    found.add(str(name))
    return len(w), len(hit), sorted(found)


def test_search_against_brute_force():
    rng = random.Random(2)
    vocabulary = [f"w{i}" for i in range(12)]
    items = [(n, " ".join(rng.choices(vocabulary, k=rng.randrange(1, 25)))) for n in range(40)]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randrange(0, 60))) for _ in range(80)]
    texts += ["pre " + items[n][1].upper() + ", post" for n in range(40)]
    for got, t in zip(decontam.search(decontam.build_index(items), pa.array(texts)), texts, strict=True):
        assert (got[0], sum(b - a for a, b in got[1]), got[2]) == plain_hits(t, items)


def test_contamination_report(spark, edge_docs, no_docs):
    bench = spark.createDataFrame(ITEMS, "item_id string, text string")
    docs = edge_docs
    for block_words in (500_000, 20):  # one block, and several
        got = by_id(decontam.contamination_report(docs, bench, block_words=block_words))
        for i, t in enumerate(TEXTS):
            n, hit, found = plain_hits(t, ITEMS)
            r = got[i]
            assert (r["n_words"], r["n_hit"], r["n_items"]) == (n, hit, len(found)), i
            assert r["items_sha256"] == hashlib.sha256(",".join(found).encode()).hexdigest()
            assert r["contaminated"] == (hit > 0)
    kept = decontam.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, t in enumerate(TEXTS) if not plain_hits(t, ITEMS)[1]}
    assert decontam.contamination_report(no_docs, bench).count() == 0
    assert not any(r.contaminated for r in decontam.contamination_report(docs, bench.where("false")).collect())
    assert lower("ÀB") == "Àb" and len(LONG) > 100_000


def test_long_runs_and_many_findings_take_linear_time():
    import time

    start = time.perf_counter()
    assert secrets.candidates("x" * 1_000_000, []) == []  # letters without a digit
    assert secrets.candidates("x" * 999_999 + "1", []) == [(0, 1_000_000)]
    text = "password=secret1234 abcdefgh1234567 " * 100_000
    spans = secrets.base_spans(text)
    assert len(spans) == 100_000 and len(secrets.candidates(text, spans)) == 100_000
    assert time.perf_counter() - start < 20


def test_candidates_by_brute_force():
    rng = random.Random(11)
    for _ in range(200):
        text = "".join(rng.choices("aaab1=: password=AKIAZ09f", k=120)) + "aaaaaaaaaaaaa1" * rng.randrange(3)
        spans = secrets.base_spans(text)
        want = [m.span() for m in re.finditer(r"[A-Za-z0-9+/_=-]{12,}", text)
                if re.search("[0-9]", m[0]) and re.search("[A-Za-z]", m[0])
                and not any(s < m.end() and m.start() < e for _, s, e in spans)]
        assert secrets.candidates(text, spans) == want


def test_repeated_and_nameless_items(spark):
    """Items repeated in bulk are read once; one without an id stands as an empty one."""
    passage = "one two three four five six seven eight nine ten eleven"
    items = spark.createDataFrame([("a", passage)] * 500 + [(None, "red green blue"), ("b", None)], "item_id string, text string")
    assert sorted(x for block in decontam.item_blocks(items, "item_id", "text", 1000) for x in block) == [
        ("", "red green blue"), ("a", passage)]
    docs = spark.createDataFrame([(1, "x " + passage), (2, "Red, green; blue"), (3, "none")], "doc_id long, text string")
    got = by_id(decontam.contamination_report(docs, items))
    assert [(got[i]["n_items"], got[i]["n_hit"]) for i in (1, 2, 3)] == [(1, 11), (1, 3), (0, 0)]
    assert got[1]["items_sha256"] == hashlib.sha256(b"a").hexdigest()
    assert got[2]["items_sha256"] == hashlib.sha256(b"").hexdigest()


def test_words_that_polynomial_hashes_confuse(spark):
    """Thue-Morse words and their complements are different words to every operator."""
    bits = [0]
    while len(bits) < 1024:
        bits += [1 - b for b in bits]
    one, other = ("".join(x[b] for b in bits) for x in ("ab", "ba"))
    items = spark.createDataFrame([("i", one)], "item_id string, text string")
    docs = spark.createDataFrame([(1, f"see {one} here"), (2, f"see {other} here")], "doc_id long, text string")
    got = by_id(decontam.contamination_report(docs, items))
    assert (got[1]["n_hit"], got[2]["n_hit"]) == (1, 0)
    for short in (128, 256, 512, 1024):
        data = np.frombuffer((one[:short] + other[:short]).encode(), np.uint8)
        a, b = span_hashes(data, np.array([0, short]), np.array([short, 2 * short])).tolist()
        assert a != b
