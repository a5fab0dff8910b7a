"""Near-duplicates, URL rules, fingerprints and the pipeline."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from llm_cases import TEXTS, by_id, lower

import corpus_pipeline
from revcast.llm import components, fingerprints, neardup, urls
from revcast.llm.text import span_hashes, utf8

SF = "/root/testdata/sf0.001"


# --- near-duplicates -----------------------------------------------------

def shingles(text, width):
    w = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    return {tuple(w[i:i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set()


def plain_groups(docs, width, percent=80):
    """Least reachable id and set size by comparing all pairs."""
    sets = [(i, shingles(t, width)) for i, t in docs]
    parent = {i: i for i, _ in docs}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    return {i: (len(s), find(i)) for i, s in sets}


def assert_groups(df, docs, width):
    got = by_id(neardup.near_duplicates(df, width=width))
    for i, (n, least) in plain_groups(docs, width).items():
        assert (got[i]["n_shingles"], got[i]["component_id"], got[i]["kept"]) == (n, least, i == least), i


def test_near_duplicates_of_given_documents(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    docs = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    assert_groups(df, docs, 2)


@pytest.mark.parametrize("salt", [neardup.SALT, 3])
def test_chains_families_and_edges(spark, edge_docs, monkeypatch, salt):
    monkeypatch.setattr(neardup, "SALT", salt)
    rng = random.Random(8)
    docs = list(enumerate(TEXTS))
    base = [f"w{rng.randrange(400)}" for _ in range(60)]
    for k in range(120):  # a family whose members drift away from the first one, in chains
        if k % 40 == 0:
            now = list(base) if k < 80 else [f"v{rng.randrange(400)}" for _ in range(60)]
        now = list(now)
        now[rng.randrange(60)] = f"x{k}"
        docs.append((1000 + rng.randrange(10**6) * 200 + k, " ".join(now)))
    for k in range(60):  # one family around one text: a hot key
        w = list(base)
        w[rng.randrange(60)] = f"y{k}"
        docs.append((500 + k, " ".join(w)))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert_groups(df, docs, 2)
    got = by_id(neardup.near_duplicates(edge_docs))
    assert got[13]["component_id"] == 12 and not got[13]["kept"] and got[0]["n_shingles"] == 0
    assert set(neardup.near_duplicates(edge_docs).columns) == {"doc_id", "n_shingles", "component_id", "kept"}


def thue_morse(n):
    """A text and its complement, which polynomial hashes mod 2^64 can't tell apart."""
    bits = [0]
    while len(bits) < n:
        bits += [1 - b for b in bits]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


def test_unlike_words_have_unlike_hashes(spark):
    one, other = thue_morse(1024)
    assert len(set(span_hashes(*(np.frombuffer((one + other).encode(), np.uint8), np.array([0, 1024]), np.array([1024, 2048]))).tolist())) == 2
    short, shorter = thue_morse(128)
    df = spark.createDataFrame([(1, one), (2, other), (3, short), (4, shorter), (5, one)], "doc_id long, text string")
    got = by_id(neardup.near_duplicates(df))
    assert {i: r["component_id"] for i, r in got.items()} == {1: 1, 2: 2, 3: 3, 4: 4, 5: 1}


def test_a_family_with_many_outside_members(spark):
    """Copies around a text and many that are just too far from all others, a
    third of all rows: few pairs, no link lost."""
    rng = random.Random(21)
    base = [f"w{k}" for k in range(100)]

    def changed(k, tag):
        w = list(base)
        for at in rng.sample(range(100), k):
            w[at] = f"{tag}{rng.randrange(10**6)}"
        return " ".join(w)

    docs = [(0, " ".join(base))] + [(i, changed(rng.randrange(1, 14), "x")) for i in range(1, 250)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    assert_groups(df, docs, 2)
    assert len({r[1] for r in plain_groups(docs, 2).values()}) > 20


def test_rows_without_id_and_repeated_ids(spark, no_docs):
    long_a, long_b = " ".join(f"a{i}" for i in range(20)), " ".join(f"b{i}" for i in range(20))
    df = spark.createDataFrame([(None, long_a), (7, long_a), (5, long_b), (7, long_b), (9, long_b), (11, "z")],
                               "doc_id long, text string")
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in neardup.near_duplicates(df).collect()),
                 key=lambda x: (x[0] or 0, str(x)))
    assert got == [(None, None, True), (5, 5, True), (7, 5, False), (7, 5, False), (9, 5, False), (11, 11, True)]
    assert neardup.near_duplicates(no_docs).count() == 0


def test_each_text_of_a_repeated_id_has_its_links(spark):
    rng = random.Random(4)

    def text(name, n):
        return [f"{name}{rng.randrange(10**6)}" for _ in range(n)]

    small, large, third, other = text("s", 60), text("l", 200), text("t", 90), text("o", 150)
    docs = [(1, small), (1, large), (1, third), (2, small[:55]), (3, large[:190]), (4, third[:85]),
            (5, other), (6, other), (6, small[:57]), (7, text("z", 40)), (8, small[5:]), (9, third[3:])]
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in docs], "doc_id long, text string").repartition(3)
    got = {(r.doc_id, r.component_id, r.kept) for r in neardup.near_duplicates(df).collect()}
    # 5 and 6 have one text, 6 and 1 are near: all but 7 hang together.
    assert got == {(i, 1, i == 1) for i in (1, 2, 3, 4, 5, 6, 8, 9)} | {(7, 7, True)}


def family_of(spark, sets, linked):
    """Candidates among the members of a family with centre 0, of which some are in its component."""
    families = spark.createDataFrame([(0, i, 0 if i in linked or not i else i, len(sets)) for i in sets],
                                     "family long, id long, c long, size long")
    frame = spark.createDataFrame([(i, bytearray(np.array(sorted(s), np.uint64).tobytes())) for i, s in sets.items()],
                                  "id long, set binary")
    return {(r.a, r.b) for r in neardup._family_pairs(families, frame, 80).collect()}


def like(a, b):
    return 100 * len(a & b) >= 80 * len(a | b)


@pytest.mark.parametrize("others", [4, 70])
def test_member_outside_meets_one_linked_to_the_hub(spark, others):
    hub = set(range(100))
    sets = {0: hub, 1: hub - {0, 1, 2, 3} | set(range(1000, 1021)), 2: hub - {0, 1, 2}}
    sets |= {3 + k: hub - {50} | {2000 + k} for k in range(others)}
    assert not like(sets[1], hub) and like(sets[2], hub) and like(sets[1], sets[2])
    assert (2, 1) in family_of(spark, sets, [i for i in sets if i not in (0, 1)])


def test_no_link_of_a_family_is_lost(spark):
    rng = random.Random(12)
    hub = set(range(100))
    sets, new = {0: hub}, list(range(1000, 1040))
    for k in range(1, 150):
        sets[k] = hub - set(rng.sample(range(25), rng.randrange(14))) | set(rng.sample(new, rng.randrange(30)))
    sets |= {200 + k: set(rng.sample(range(5000, 5040), 30)) | {rng.randrange(100)} for k in range(60)}  # strays
    linked = [i for i in sets if i and like(sets[i], hub)]
    found = family_of(spark, sets, linked)
    wanted = {(a, b) for a in sets for b in sets if a > b > 0 and like(sets[a], sets[b]) and not {a, b} <= set(linked)}
    assert len(wanted) > 100 and wanted <= found


def test_index_guarantees_the_signature_distance():
    rng = np.random.default_rng(9)
    limit = neardup.CHUNKS * (neardup.ERRORS + 1) - 1
    a = rng.integers(0, 256, (200, neardup.VALUES), dtype=np.uint8)
    b = a.copy()
    for row in b:  # as many errors as are allowed, anywhere
        at = rng.choice(neardup.VALUES, limit, replace=False)
        row[at] ^= rng.integers(1, 256, limit, dtype=np.uint8)
    meet = (neardup.index_keys(a) == neardup.index_keys(b)).any(axis=1)
    assert meet.all()


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (200, 201), (201, 200)]
    got = {r.node: r.component for r in components.star_components(
        spark.createDataFrame(links, "a long, b long")).collect()}
    want = {i: 0 for i in range(1, 61)} | {100 + i: 100 for i in range(1, 30)} | {201: 200}
    assert got == want


# --- URLs ----------------------------------------------------------------

def plain_judgement(url, rules, blocked):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = lower(re.match(r"[^/?#]*", rest)[0])
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    fits = []
    for rule, verdict in rules:
        h, slash, p = rule.partition("/")
        if host and (host == h or host.endswith("." + h)) and path.startswith(slash + p):
            fits.append((len(rule), len(h), rule, verdict))
    if fits:
        return host, path, max(fits)[2], max(fits)[3]
    hit = any(host == b or host.endswith("." + b) for b in blocked) if host else False
    return host, path, None, "block" if hit else "allow"


URLS = [None, "", "no scheme", "http://", "http:///x", "HTTP://Example.ORG/es/1", "https://a.example.org/en/12?q#f",
        "https://example.org", "https://example.org?x/es/", "ftp://b.com/fr/", "ftp://b.com/fr", "x://com/de/9", "x://b.com/de/#",
        "https://notexample.org/es/a", "https://a.b.casino-win.example.com/en/1", "https://casino-win.example.com",
        "https://my.ads.net/", "https://loads.net/", "a://b://c.org/x", "https://example.org/ES/1", "x://é.org/é"]


def test_url_rules(spark):
    pages = spark.createDataFrame([(i, u, "r", "v") for i, u in enumerate(URLS + URLS[6:8])],
                                  "page_id long, url string, rule string, verdict string")
    listed = urls.hosts_with_words(pages)
    blocked = [r.host for r in listed.collect()]
    assert sorted(blocked) == ["a.b.casino-win.example.com", "casino-win.example.com", "my.ads.net"]
    got = by_id(urls.judge_urls(pages, listed=listed), "page_id")
    for i, u in enumerate(URLS):
        r = got[i]
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == plain_judgement(u, urls.RULES, blocked), u
    assert urls.judge_urls(pages.where("false")).count() == 0
    assert urls.judge_urls(spark.createDataFrame([(1, None)], "page_id long, url string")).first().verdict == "allow"


def test_cascade_is_exact_on_its_universe(spark):
    keys = spark.range(20_000).selectExpr("concat('key', id) as key")
    listed = spark.range(0, 20_000, 9).selectExpr("concat('key', id) as key")
    cascade = urls.build_cascade(listed.union(listed), keys)
    assert len(cascade.levels) > 1
    a, b = urls.key_hashes(keys["key"])
    got = keys.select("key", a.alias("a"), b.alias("b")).toPandas()
    member = cascade.contains(got.a.to_numpy(), got.b.to_numpy())
    assert (member == got.key.str[3:].astype(int).mod(9).eq(0).to_numpy()).all()
    empty = urls.build_cascade(listed.where("false"), keys)
    assert not empty.contains(got.a.to_numpy(), got.b.to_numpy()).any()
    with pytest.raises(ValueError):
        urls.build_cascade(keys, keys, max_filter_bytes=100)


# --- fingerprints --------------------------------------------------------

def plain_syncmers(data):
    k, s = fingerprints.K, fingerprints.S
    out = []
    for i in range(len(data) - k + 1):
        part = np.frombuffer(data[i:i + k], np.uint8)
        h = fingerprints._s_hashes(part)[1].tolist()
        assert len(h) == k - s + 1
        if min(h) in (h[0], h[-1]):
            out.append(i)
    return out


def test_syncmers_are_context_free():
    rng = random.Random(5)
    for size in (0, 5, 11, 12, 13, 200):
        data = bytes(rng.choices(b"abcd ", k=size))
        at, h = fingerprints.syncmers(np.frombuffer(data, np.uint8))
        assert at.tolist() == plain_syncmers(data)
        shifted, h2 = fingerprints.syncmers(np.frombuffer(b"zzz" + data, np.uint8))
        assert {(a + 3, x) for a, x in zip(at.tolist(), h.tolist(), strict=True)} <= set(
            zip(shifted.tolist(), h2.tolist(), strict=True))


def plain_least(h):
    values = np.unique(h).tolist()
    return values[:max(fingerprints.SIZE, sum(v <= fingerprints.LIMIT for v in values))]


def test_least_anchors_do_not_depend_on_the_short_cut():
    rng = random.Random(6)
    data = np.frombuffer(bytes(rng.choices(b"abcdefghij ", k=60_000)), np.uint8)
    at, h = fingerprints.syncmers(data)
    assert fingerprints._least(at, h)[0] == plain_least(h)
    assert len(plain_least(h)) > 600  # they grow with the text
    tiny = np.frombuffer(b"ab" * 30_000, np.uint8)  # few distinct anchors in a long text
    at, h = fingerprints.syncmers(tiny)
    assert fingerprints._least(at, h)[0] == plain_least(h)


def test_a_passage_shared_by_two_long_texts_is_seen():
    rng = random.Random(7)
    words = [f"w{rng.randrange(10**6)}" for _ in range(60_000)]
    passage = " ".join(words[:100])
    one, other = passage + " " + " ".join(words[100:20_000]), " ".join(words[20_000:]) + " " + passage
    a, b = fingerprints.sketch(one), fingerprints.sketch(other)
    assert fingerprints.likeness(a, b) > 0 and set(a[0]) & set(b[0]) >= set(fingerprints.sketch(passage)[0][:5])


def test_likeness_by_brute_force():
    """Over texts of all kinds: the anchors that both sketches have all of, and the longest
    chain of common ones found by quadratic dynamic programming."""
    rng = random.Random(8)
    base = "".join(rng.choices("abcdefgh ", k=9_000))
    texts = [base, base[3_000:] + base[:3_000], base[:200], base[:2_000] + "x" * 50 + base[2_000:], "tiny", base[5_000:5_300]]
    for s in texts:
        for t in texts:
            x, y = (dict(zip(*fingerprints.sketch(u), strict=True)) for u in (s, t))
            limit = min((1 << 32) - 1 if len(z) < fingerprints.SIZE else max(fingerprints.LIMIT, sorted(z)[fingerprints.SIZE - 1])
                        for z in (x, y))
            union = [h for h in x.keys() | y.keys() if h <= limit]
            common = sorted((x[h], y[h]) for h in union if h in x and h in y)
            best = []
            for i, (p, q) in enumerate(common):
                best.append(1 + max((best[j] for j in range(i) if common[j][0] < p and common[j][1] < q), default=0))
            want = 1.0 if x == y else max(best, default=0) / len(union) if union else 0.0
            assert fingerprints.likeness(fingerprints.sketch(s), fingerprints.sketch(t)) == pytest.approx(want), (s[:9], t[:9])


def expected_pairs(docs):
    rows = sorted(docs, key=lambda r: (-r[0], r[1]))
    for n, (i, t) in enumerate(rows):
        following = rows[(n + 1) % len(rows)][1]
        k = len(t) // 3
        yield i, t, following, t[:len(t) - k] + following[:k]


@pytest.mark.parametrize("rows_per_range", [4000, 3])
def test_neighbours(spark, monkeypatch, rows_per_range):
    monkeypatch.setattr(fingerprints, "ROWS_PER_RANGE", rows_per_range)
    docs = [(i * 7 % 101, t or "") for i, t in enumerate(TEXTS)] + [(300 + i, f"text number {i} " * 9) for i in range(9)]
    df = spark.createDataFrame([(i, t if t else None, "x") for i, t in docs], "doc_id long, text string, fingerprint string")
    got = by_id(fingerprints.compare_with_neighbours(df))
    assert len(got) == len(docs)
    own = {i: fingerprints.sketch(t) for i, t in docs}
    for i, t, following, changed in expected_pairs(docs):
        r = got[i]
        assert r["n_chars"] == len(t) and r["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        assert r["fingerprint"] == fingerprints.as_string(own[i])
        assert r["edited_fingerprint"] == fingerprints.as_string(fingerprints.sketch(changed))
        assert r["near_edited"] == fingerprints.likeness(own[i], fingerprints.sketch(changed))
        assert r["near_next"] == fingerprints.likeness(own[i], fingerprints.sketch(following))


def test_neighbours_of_tables_without_neighbours(spark, no_docs, edge_docs):
    assert fingerprints.compare_with_neighbours(no_docs).count() == 0
    one = spark.createDataFrame([(4, "abcdef")], "doc_id long, text string")
    r = fingerprints.compare_with_neighbours(one).first()
    assert r.near_next == 1 and r.edited_sha256 == hashlib.sha256(b"abcdab").hexdigest()
    assert fingerprints.compare_with_neighbours(edge_docs).count() == len(TEXTS) + 1
    nulls = spark.createDataFrame([(None, "abcdef"), (3, "uvwxyz"), (None, None)], "doc_id long, text string")
    assert fingerprints.compare_with_neighbours(nulls).count() == 3
    assert fingerprints.fingerprints(edge_docs).count() == len(TEXTS) + 1
    a = fingerprints.sketches(*utf8(pa.array(["same text of some length here"] * 2)))
    assert a[0] == a[1] and fingerprints.likeness(a[0], a[1]) == 1 and fingerprints.likeness(([], []), a[0]) == 0


# --- pipeline ------------------------------------------------------------

def test_pipeline_against_brute_force(spark, edge_docs):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rows = {r.doc_id: r.text for r in docs.collect()}
    known = {i: t for i, t in rows.items() if any(c.isalpha() for c in t or "")}
    groups = plain_groups(list(known.items()), 5)
    kept = {i: t for i, t in known.items() if groups[i][1] == i}
    windows = defaultdict(set)
    from llm_cases import words

    for t in bench:
        w = words(t)
        for k in range(max(1, len(w) - 9) if w else 0):
            windows[min(10, len(w))].add(tuple(w[k:k + 10]))
    clean = {i for i, t in kept.items() if not any(
        tuple(words(t)[k:k + m]) in found for m, found in windows.items() for k in range(len(words(t)) - m + 1))}
    out = {r.doc_id: r for r in corpus_pipeline.run(spark, SF).collect()}
    assert set(out) == clean
    assert all(r.n_tokens == len(r.ids) for r in out.values())


def test_stages_on_edge_cases(spark, edge_docs, no_docs):
    for name, stage in corpus_pipeline.STAGES:
        made, none = stage(spark, edge_docs, SF), stage(spark, no_docs, SF)
        assert none.count() == 0
        if name != "bpe_encode":
            assert made.columns == edge_docs.columns
        rows = [r.doc_id for r in made.collect()]
        if name == "language_id":
            assert set(rows) == {i for i, t in enumerate(TEXTS) if any(c.isalpha() for c in t or "")}
        if name == "near_dedup":
            assert rows.count(12) == 1 and 13 not in rows
        if name in ("secret_scan", "bpe_encode"):
            assert len(rows) == len(TEXTS) + 1


def test_near_dedup_keeps_other_texts_of_a_repeated_id(spark):
    a, b, c = (" ".join(f"{name}{i}" for i in range(60)) for name in "abc")
    rows = [(1, a), (1, b), (1, b), (1, a + " end"), (2, a), (3, b), (7, b), (7, c), (9, c), (None, a), (4, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(map(str, map(tuple, corpus_pipeline.near_dedup(spark, df, SF).collect())))
    either = [sorted(map(str, [(1, x), (1, b), (7, c), (None, a), (4, "z")])) for x in (a, a + " end")]
    assert got in either


def test_all_queries_are_registered():
    import __spark_entry__

    names = __spark_entry__.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))


@pytest.mark.parametrize("name", ["op6_near_duplicates", "op7_url_filter", "op10_decontamination"])
def test_query_matches_sql(spark, name):
    import duckdb

    from revcast.llm.oracle import ORACLE_SQL
    from revcast.llm.queries import QUERIES

    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = con.execute(ORACLE_SQL[name])
    columns = [c[0] for c in want.description]
    df = QUERIES[name](spark, SF)
    assert sorted(columns) == sorted(df.columns)
    assert sorted(map(str, df.select(*columns).toPandas().itertuples(index=False))) == sorted(
        map(str, want.df().itertuples(index=False)))


def test_stages_keep_columns_of_any_name(spark):
    docs = spark.createDataFrame([(i, "some words of a text that is long enough to be known " * 3, "en", "s", 9, "x", "y")
                                  for i in (1, 1, 2)], "doc_id long, text string, lang string, source string, n_chars long, "
                                 "`a.b` string, `c d` string")
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, SF)
        assert {"a.b", "c d"} <= set(made.columns), name
        assert all(r["a.b"] == "x" for r in made.collect()), name
