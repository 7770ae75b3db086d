import hashlib
import itertools
import random
import zlib
from collections import Counter, defaultdict

import pytest

from tallyward.llm import prefix_trie as p
from tallyward.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string, place int, digest string, `a.b` int"


def brute(rows):
    """Rows (conv_id, turn, role, text) by the definition, over plain dictionaries."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            what = (role or "", text or "")
            digest = hashlib.sha256(f"{len(what[0])}:{what[0]}{what[1]}".encode()).hexdigest()[: p.SIGNS]
            own[c].append(((turn is not None, turn or 0, digest), what))
    own = {c: [w for _, w in sorted(turns)] for c, turns in own.items()}
    members = defaultdict(list)
    whole = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        whole[c] = own.get(c - c % 100, [])[:h] + own[c][h:]
        for d in range(len(whole[c]) + 1):
            members[tuple(whole[c][:d])].append(c)
    children = Counter(k[:-1] for k in members if k)
    leaves, saved = Counter(), Counter()
    for k, v in members.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += not children[k]
            saved[k[:d]] += (len(v) - 1) * (len(k[-1][1]) if k else 0)
    ends = lambda k: ",".join(str(c) for c in sorted(members[k]) if len(whole[c]) == len(k))
    return sorted(
        (min(v), len(k), min(members[k[:-1]]) if k else -1, len(v), children[k], leaves[k], saved[k], hashlib.sha256(ends(k).encode()).hexdigest())
        for k, v in members.items()
    )


def found(df):
    return sorted(tuple(-1 if v is None else v for v in r) for r in df.select(p.NODE_NAMES).collect())


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA)


def test_query_over_conversations(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found(QUERIES["op12_prefix_trie"](spark, folder)) == brute(rows)


@pytest.mark.parametrize("members", [3, 50_000])
@pytest.mark.parametrize("seed", range(3))
def test_random_conversations(spark, monkeypatch, seed, members):
    monkeypatch.setattr(p, "SHARD_MEMBERS", members)
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(900), 120):
        if c % 7 == 0:  # copies
            rows += [(c, t, "user", f"copy {t}") for t in range(9)]
        else:
            rows += [(c, t, rng.choice(["user", "bot"]), rng.choice(["a", "bb", "ç日"])) for t in range(rng.randint(1, 9))]
    rng.shuffle(rows)
    assert found(p.conversation_trie(frame(spark, rows))) == brute(rows)


def test_awkward_rows(spark):
    rows = [
        (0, None, None, "first"), (0, 1, "user", None), (0, 1, "user", None), (0, 2, None, None), (0, 3, "user", "x" * 100_000), (0, 4, "user", "end"), (0, 5, "a", "b"),
        (1, 0, "user", "x"), (1, 0, "user", "y"), (2, 0, "user", "x"), (None, 0, "user", "lost"), (150, 1, "bot", "z"), (351, None, None, None), (352, 7, "", ""),
    ]
    assert found(p.conversation_trie(frame(spark, rows))) == brute(rows)
    assert p.conversation_trie(frame(spark, [])).collect() == []


def test_one_very_long_conversation_and_its_copy(spark):
    rows = [(c, t, "user", f"turn {t}") for c in (200, 500) for t in range(3000)] + [(700, t, "user", f"own {t}") for t in range(3000)]
    assert found(p.conversation_trie(frame(spark, rows))) == brute_chain(rows)


def brute_chain(rows):
    """Two equal conversations and one of its own, whose ids are hundreds and so keep their turns."""
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    size = [len(f"turn {t}") for t in range(3000)]
    below = list(itertools.accumulate(reversed(size)))[::-1]
    out = [(200, 0, -1, 3, 2, 2, below[0], p.EMPTY)]
    for d in range(1, 3001):
        last = d == 3000
        out.append((200, d, 200, 2, int(not last), 1, below[d - 1], sha("200,500") if last else p.EMPTY))
        out.append((700, d, 200 if d == 1 else 700, 1, int(not last), 1, 0, sha("700") if last else p.EMPTY))
    return sorted(out)


def test_median_first():
    assert list(p.medians(0)) == [] and sorted(p.medians(10)) == list(range(10)) and next(p.medians(9)) == 4
    tree = p.TernaryTree()
    for at in p.medians(1023):
        tree.insert([at], at, 1, at)
    depths = [0] * 1024
    for node in range(1, 1024):
        for child in (tree.low[node], tree.high[node]):
            if child >= 0:
                depths[child] = depths[node] + 1
    assert max(depths) == 9


def test_ranges_of_one_group_of_copies(spark, monkeypatch):
    monkeypatch.setattr(p, "SHARD_MEMBERS", 5)
    rows = [(c * 100, t, "user", f"same {t}") for c in range(60) for t in range(3)] + [(c * 100 + 7, 0, "bot", str(c)) for c in range(60)]
    assert found(p.conversation_trie(frame(spark, rows))) == brute(rows)
