"""Merkle manifest, source mixture and spelling variants against plain Python."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from llm_cases import lower

from revcast.llm import merkle, mixing, spelling
from revcast.llm.oracle import ORACLE_SQL
from revcast.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op11_merkle_manifest", "op12_source_mixture", "op13_spelling_variants"])
def test_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    made = QUERIES[name](spark, SF)
    got = con.execute(ORACLE_SQL[name])
    names = [c[0] for c in got.description]
    assert sorted(names) == sorted(made.columns)
    assert sorted(map(str, got.fetchall())) == sorted(str(tuple(r)) for r in made.select(*names).collect())


# --- Merkle manifest -----------------------------------------------------

def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_tree(nodes):
    """Root and, for each node, its siblings and the levels' left and right parts."""
    paths = [[] for _ in nodes]
    place = list(range(len(nodes)))
    while len(nodes) > 1:
        for i, path in enumerate(paths):
            run = place[i] // 8 * 8
            path.append(("".join(nodes[run:place[i]]), "".join(nodes[place[i] + 1:run + 8])))
            place[i] //= 8
        nodes = [sha("".join(nodes[k:k + 8])) for k in range(0, len(nodes), 8)]
    return nodes[0], paths


def plain_leaf(row, low=False):
    values = [row[c] for c in merkle.COLUMNS]
    if low and values[4] is not None:
        values[4] = lower(values[4])
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain_manifest(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r["lang"]].append((r["doc_id"] is not None, r["doc_id"] or 0, plain_leaf(r), r))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        groups[g].sort(key=lambda x: x[:3])
        trees[g] = plain_tree([x[2] for x in groups[g]])
    root, upper = plain_tree([trees[g][0] for g in order])
    out = []
    for g, above in zip(order, upper, strict=True):
        for (_, _, leaf, r), own in zip(groups[g], trees[g][1], strict=True):
            path = own + above
            third = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0
            node = plain_leaf(r, low=third)
            for a, b in path:
                node = sha(a + node + b)
            out.append((r["doc_id"], leaf, trees[g][0], root, sha("".join(a + b for a, b in path)), node, node == root))
    return out


def assert_manifest(df):
    rows = [r.asDict() for r in df.collect()]
    got = [tuple(r) for r in merkle.tampering_report(df).collect()]
    assert sorted(map(str, got)) == sorted(map(str, plain_manifest(rows)))
    return got


def test_manifest_of_edge_rows(spark, edge_docs, no_docs):
    assert_manifest(edge_docs)
    assert merkle.tampering_report(no_docs).count() == 0
    got = assert_manifest(edge_docs.where("doc_id = 9"))  # a lone leaf is its subroot, and the root
    assert got[0][1] == got[0][2] == got[0][3] and got[0][4] == sha("")


def test_manifest_of_many_groups_and_superblocks(spark):
    # 1,300 rows of one language (superblocks in two rounds) and 600 small ones (likewise above).
    rows = [(i if i % 50 else None, "S", "en" if i < 1300 else f"l{i % 600}", i, f"Text {i % 9}") for i in range(2200)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(5)
    got = assert_manifest(df)
    assert {r[6] for r in got} == {True, False}


def test_proofs_are_real_outputs(spark, edge_docs):
    made = merkle.manifest(edge_docs).collect()
    assert all(merkle.fold(r.leaf, r.proof) == r.root == r.folded_root for r in made)


# --- source mixture ------------------------------------------------------

def plain_targets(sizes):
    """Targets by sharing the excess again and again; exact fractions are not needed."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: 1 + i % 3 for i, s in enumerate(order)}
    left, capped, total = set(order), {}, sum(sizes.values())
    while left:
        share = (total - sum(capped.values())) / sum(weight[s] for s in left)
        over = {s for s in left if 3 * sizes[s] <= share * weight[s]}
        if not over:
            return {**capped, **{s: share * weight[s] for s in left}}
        capped.update({s: 3 * sizes[s] for s in over})
        left -= over
    return capped


def assert_mixture(df):
    rows = df.select("doc_id", "source", "text").collect()
    sizes = [len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in rows]
    of_source = Counter()
    for r, n in zip(rows, sizes, strict=True):
        of_source[r.source] += n
    targets = plain_targets(of_source)
    made = mixing.mix(df).collect()
    assert sorted((str(r.doc_id), r.size) for r in made) == sorted((str(r.doc_id), n) for r, n in zip(rows, sizes, strict=True))
    # The mix is a prefix of the turns by finish time: its words fit, and one more turn would not.
    turns = [(r.finish + k * r.source_size / w, r.size, k < r.takes) for r in made if r.size
             for w in [r.source_size and weight_of(r, targets, of_source)] for k in range(3)]
    taken = sum(n for _, n, t in turns if t)
    rest = [(f, n) for f, n, t in turns if not t]
    assert taken <= sum(sizes) and (not rest or taken + min(rest)[1] > sum(sizes))
    assert not rest or max(f for f, _, t in turns if t) <= min(rest)[0] + 1e-9
    assert all(r.takes <= 3 and (r.size or not r.takes) for r in made)
    known = Counter()
    largest = Counter()
    for r in made:
        known[r.source_size, round(r.target, 6)] += r.size * r.takes
        largest[r.source_size, round(r.target, 6)] = max(largest[r.source_size, round(r.target, 6)], r.size)
    # Every source is within two documents of its target.
    slack = 2 * max(sizes, default=0)
    wanted = Counter()
    for s, n in of_source.items():
        wanted[n, round(float(targets[s]), 6)] += targets[s]
    assert known.keys() == wanted.keys()
    assert all(abs(known[k] - wanted[k]) <= slack * sum(1 for s in of_source if of_source[s] == k[0]) for k in known)


def weight_of(row, targets, sizes):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    return next(1 + i % 3 for i, s in enumerate(order) if sizes[s] == row.source_size and abs(targets[s] - row.target) < 1e-6)


def test_mixture_of_edge_rows(spark, edge_docs, no_docs):
    assert_mixture(edge_docs)
    assert mixing.mixture_report(no_docs).count() == 0
    blank = mixing.mixture_report(edge_docs.where("doc_id < 4")).collect()  # no words at all
    assert {(r.size, r.taken) for r in blank} == {(0, 0)}


def test_mixture_with_hot_source_capped_sources_and_repeated_rows(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(["w"] * rng.randrange(1, 40)), rng.choice([None, "a", "b", "hot", "hot", "hot", "é"])) for i in range(600)]
    rows += [(1000 + i, "w w w", "tiny") for i in range(4)] + [(7, "x y z", "hot")] * 300 + [(None, "q", "b")] * 40
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(7)
    assert_mixture(df)
    first = sorted(map(str, mixing.mixture_report(df).collect()))
    assert first == sorted(map(str, mixing.mixture_report(df.repartition(3)).collect()))  # reruns agree


def test_mixture_in_several_buckets_and_copies(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 20)
    monkeypatch.setattr(mixing, "COPIES", 7)
    rows = [(i, "w " * (1 + i % 13), "s" if i % 3 else f"t{i % 2}") for i in range(300)] + [(5, "a b", "s")] * 60
    assert_mixture(spark.createDataFrame(rows, "doc_id long, text string, source string"))


def test_mixture_is_native(spark):
    plan = mixing.mixture_report(spark.read.parquet(f"{SF}/documents.parquet"))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# --- spelling variants ---------------------------------------------------

def plain_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(a == b[:k] + b[k + 1:] for k in range(len(b)))


def plain_variants(rows):
    n = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            n[run[:h % len(run)] + run[h % len(run) + 1:] if h % 97 == 0 else run] += 1
    n = {w: k for w, k in n.items() if len(w) >= 5 and k >= 3}
    near = {w: [v for v in n if plain_near(v, w)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None

    def last(w):
        return w if form[w] is None else last(form[w])

    return {(w, form[w], last(w), n[w], len(near[w]), n.get(form[w])) for w in n}


def assert_variants(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = [tuple(r) for r in spelling.variants(df).select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(got) == len(set(got)) and set(got) == plain_variants(rows)
    return got


def family(rng, base, k, letters="abcdé"):
    """Words around one, by chains of single changes."""
    out = [base]
    while len(out) < k:
        w = rng.choice(out)
        at = rng.randrange(len(w) + 1)
        out.append(rng.choice([w[:at] + rng.choice(letters) + w[at:], w[:at] + w[at + 1:], w[:at] + rng.choice(letters) + w[at + 1:]]))
    return out


def test_variants_of_families(spark):
    rng = random.Random(5)
    words = [w for base in ("abcdabcd", "receive", "naïveté", "zzzzzzzzz") for w in family(rng, base, 120)]
    rows = [(i, " ".join(rng.choices(words, k=60)) + ", " + rng.choice(words).upper()) for i in range(150)]
    rows += [(None, None), (None, "Receive receive RECEIVE"), (3, ""), (4, "x" * 100_000)] + [(9, "y" * 5000 + " hello")] * 3
    got = assert_variants(spark, rows)
    assert any(r[1] and r[2] != r[1] for r in got)  # chains of forms


def test_variants_where_all_pages_are_split(spark, monkeypatch):
    monkeypatch.setattr(spelling, "PAGE", 3)
    rng = random.Random(6)
    words = family(rng, "abcdabcdab", 150, "abcd") + ["".join(rng.sample("stonecar", 8)) for _ in range(60)]
    assert_variants(spark, [(i, " ".join(rng.choices(words, k=80))) for i in range(60)])


def test_variants_of_edge_rows(spark, edge_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in edge_docs.collect()]
    got = {tuple(r) for r in spelling.variants(edge_docs).select("word", "form", "root", "n", "n_near", "form_n").collect()}
    assert got == plain_variants(rows)
    assert spelling.variants(no_docs).count() == 0


def test_search_finds_all_near_pairs():
    rng = random.Random(7)
    words = sorted(set(family(rng, "abcabc", 400, "abcy")))  # y: the group of a
    own, guests = words[::2], words[1::2]
    ones = np.ones(len(words), np.int64)
    found = {(own[i], (own + guests)[j]) for i, j in spelling.search(own, own + guests, ones, ones, 0)}
    assert found == {(a, b) for a in own for b in words if plain_near(a, b)}
    assert any(a != b and spelling.vectors([a]).tolist() == spelling.vectors([b]).tolist() for a, b in found)
    visitors = list(enumerate(guests))
    for length in {len(a) for a in own}:  # the members of a leaf have one length
        members = [(i, a) for i, a in enumerate(own) if len(a) == length]
        many = list(spelling._verified(members, visitors))
        assert sorted(many) == [(i, j) for i, a in members for j, b in visitors if plain_near(a, b)]
    assert any(4 * spelling.FEW < sum(len(a) == n for a in own) * len(guests) for n in range(20))


def test_hot_leaf_is_compared_by_places_left_out():
    rng = random.Random(8)
    words = sorted({"start" + "".join(rng.choices("abc", k=6)) for _ in range(400)})
    members, visitors = list(enumerate(words[::2])), list(enumerate(words[1::2]))
    found = {(i, j) for i, a, j, b in spelling._alike(members, visitors)}
    assert len(found) < len(members) * len(visitors) / 20
    assert found == {(i, j) for i, a in members for j, b in visitors if plain_near(a, b)}


@pytest.mark.parametrize("a, b, wanted", [
    ("", "a", True), ("a", "a", False), ("ab", "ba", False), ("abc", "ac", True), ("abc", "abd", True), ("abc", "abcd", True),
    ("abcd", "bcd", True), ("aab", "ab", True), ("abc", "abcde", False), ("x" * 10**6 + "a", "x" * 10**6 + "b", True)])
def test_near(a, b, wanted):
    assert spelling.near(a, b) == spelling.near(b, a) == wanted
