import random
from collections import Counter, defaultdict

import pytest

from tallyward.llm import jaccard_join as j
from tallyward.llm.components import components
from tallyward.llm.queries import QUERIES


def shingle_set(text, size):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))) if words else frozenset()


def brute(rows, size=4, percent=85):
    """Size and component of each row, by comparing all pairs that share a shingle."""
    sets = [(i, shingle_set(t, size)) for i, t in rows]
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for at, (_, own) in enumerate(sets):
        for other, common in Counter(o for s in own for o in holders[s]).items():
            if 100 * common >= percent * (len(own) + len(sets[other][1]) - common):
                parent[root(at)] = root(other)
        for s in own:
            holders[s].append(at)
    for at, (i, _) in enumerate(sets):  # rows of one id are one document
        first = next(k for k, (o, s) in enumerate(sets) if o == i)
        if i is not None:
            parent[root(at)] = root(first)
    least = {}
    for at, (i, _) in enumerate(sets):
        r = root(at)
        least[r] = min([x for x in (least.get(r), i) if x is not None], default=None)
    return sorted(((i, len(s), least[root(at)]) for at, (i, s) in enumerate(sets)), key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("size, percent", [(4, 85), (5, 80), (2, 60)])
def test_random_near_copies(spark, size, percent):
    rng, rows = random.Random(size), []
    for base in range(12):
        words = [f"w{rng.randint(0, 300)}" for _ in range(rng.choice([6, 9, 30, 120]))]
        for _ in range(rng.choice([1, 4, 9])):
            copy = [w if rng.random() > 0.02 else f"x{rng.randint(0, 50)}" for w in words]
            rows.append((len(rows), " ".join(copy[: len(copy) - rng.randint(0, 3)])))
    common = " ".join(f"c{i}" for i in range(30))  # a passage that many texts share
    rows += [(len(rows) + i, f"{common} {' '.join(f'u{i}x{k}' for k in range(rng.choice([2, 4, 40])))}") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(j.near_groups(docs, size, percent)) == brute(rows, size, percent)


def test_frequent_hashes_are_joined_by_combinations(spark, monkeypatch):
    """Chains in which every shingle is frequent and the least member of a bucket is no neighbour."""
    monkeypatch.setattr(j, "PRODUCT", 4)
    parts = [[f"p{n}w{i}" for i in range(12)] for n in range(40)]
    rows = []
    for start in range(32):
        for turn in range(2):
            words = [w for n in range(start, start + 8) for w in parts[n]]
            rows.append((len(rows), " ".join(words[turn * 3 :])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for percent in (70, 85, 95):
        assert found(j.near_groups(docs, 4, percent)) == brute(rows, 4, percent)


def test_awkward_rows(awkward, awkward_rows, nothing):
    assert found(j.near_groups(awkward)) == brute([r[:2] for r in awkward_rows])
    left = j.drop_near_duplicates(awkward)
    assert left.columns == awkward.columns
    assert sorted({r.doc_id for r in left.collect()}, key=str) == sorted([1, None, 3, 4, 5, 6, 8, 10, 11], key=str)
    assert j.near_groups(nothing).collect() == [] and j.drop_near_duplicates(nothing).collect() == []


def test_links_through_rows_without_an_id(spark):
    words = [f"w{i}" for i in range(60)]
    near = [" ".join([*words[:at], "changed", *words[at + 1 :]]) for at in (0, 59)]
    for middle in (2, None):
        rows = [(1, near[0]), (middle, " ".join(words)), (3, near[1]), (None, "alone " * 3), (None, None), (4, ""), (5, ""), (5, near[0] + " more")]
        out = found(j.near_groups(spark.createDataFrame(rows, "doc_id long, text string"), 4, 85))
        assert out == brute(rows, 4, 85)
        assert [c for i, n, c in out if n > 50] == [1] * 4


@pytest.mark.parametrize("bits, tile", [(j.MAP_WORDS, j.TILE), (1, 7)])
def test_near_copies_just_below_the_similarity(spark, monkeypatch, bits, tile):
    """Copies of a text that is not there, each with words left out: nearly every shingle is shared, few pairs are linked."""
    monkeypatch.setattr(j, "MAP_WORDS", bits)
    monkeypatch.setattr(j, "TILE", tile)
    monkeypatch.setattr(j, "KNOWN_KEYS", 64 if tile > 7 else 5)
    rng, words = random.Random(7), [f"w{i}" for i in range(150)]
    rows = [(i, " ".join(w for w in words if rng.random() > rng.choice([0.01, 0.04]))) for i in range(150)]
    assert found(j.near_groups(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)


@pytest.mark.parametrize("percent", [50, 80, 85, 95])
def test_prefixes_of_linked_sets_share_what_is_certain(percent):
    rng = random.Random(percent)
    for _ in range(400):
        size = rng.choice([5, 20, 80, 400])
        base = rng.sample(range(10_000), size)
        a = sorted(set(base) - set(rng.sample(base, rng.randint(0, size // 4))) | set(rng.sample(range(10_000), rng.randint(0, size // 5))))
        b = sorted(set(base) - set(rng.sample(base, rng.randint(0, size // 4))))
        common = len(set(a) & set(b))
        if a and b and 100 * common >= percent * (len(a) + len(b) - common):
            shared = set(a[: j.prefix_length(len(a), percent)]) & set(b[: j.prefix_length(len(b), percent)])
            assert len(shared) >= max(j.certain(len(a), percent), j.certain(len(b), percent))


def test_clashing_columns_are_kept(spark):
    rows = [(1, "a b c d e f", 10, "x", 7), (2, "a b c d e f", 20, "y", 8), (3, "other words of its own here", 30, "z", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __gone int, `a.b` string, id int")
    assert sorted(map(tuple, j.drop_near_duplicates(docs).collect())) == [rows[0], rows[2]]


def test_hot_group_of_near_copies(spark):
    words = " ".join(f"w{i}" for i in range(60))
    docs = spark.range(900).selectExpr("id AS doc_id", f"if(id % 3 = 0, concat('{words} ', id), concat('own text number ', id, ' of no other document ', id)) AS text")
    sizes = Counter(r.component_id for r in j.near_groups(docs).collect())
    assert sizes[0] == 300 and len(sizes) == 601


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_over_documents(spark, sf):
    docs = [tuple(r) for r in spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert found(QUERIES["op5_jaccard_join"](spark, f"/root/testdata/{sf}")) == brute(docs)


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 164)] + [(500, i) for i in range(1, 90, 2)] + [(7, 7), (900, 901), (901, 900)]
    rows = {r.node: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(rows[i] == 100 for i in range(100, 165))
    assert all(rows[i] == 1 for i in [500, *range(1, 90, 2)])
    assert rows[901] == rows[900] == 900
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_no_cross_join(spark, folder):
    plan = QUERIES["op5_jaccard_join"](spark, folder)._jdf.queryExecution().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
