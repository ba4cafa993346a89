"""The prefix trie against a plain one, with ranges and segments small enough to cut everything."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from passerine.llm import prefix_trie


def plain(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(v)] for c, v in own.items()}
    members = defaultdict(list)
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        rebuilt[c] = tuple(own.get(c - c % 100, [])[:h] + turns[h:])
        for d in range(len(rebuilt[c]) + 1):
            members[rebuilt[c][:d]].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for k in members:
        if k:
            children[k[:-1]] += 1
    for k, who in members.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += not children[k]
            saved[k[:d]] += (len(who) - 1) * len(k[-1][1]) if k else 0
    out = []
    for k, who in members.items():
        ends = ",".join(str(c) for c in sorted(who) if rebuilt[c] == k)
        out.append((min(who), len(k), min(members[k[:-1]]) if k else None, len(who), children[k], leaves[k], saved[k], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def made(seed, n):
    draw = random.Random(seed)
    words = ["", "a", "bé", "ccc", "ü" * 7, None]
    rows = []
    for c in range(n):
        if draw.random() < 0.05:
            continue
        hot = draw.random() < 0.5
        turns = [("user", "hello")] * 9 if hot else [(draw.choice(["user", "bot", None]), draw.choice(words)) for _ in range(draw.choice([0, 1, 2, 3, 5, 8]))]
        turns = turns[: draw.randint(1, 9)] if hot and draw.random() < 0.5 else turns
        rows += [(c, None if k == 0 and draw.random() < 0.2 else k, r, t) for k, (r, t) in enumerate(turns)]
    for c, long in ((n + 150, 61), (n + 151, 61), (n + 152, 70), (n + 250, 33)):  # several segments, shared for a while
        rows += [(c, k, "user", f"t{k if k < 40 or c % 2 else -k}") for k in range(long)]
    return [r for r in rows]


@pytest.mark.parametrize("width,range_rows", [(16, 65_536), (3, 7), (1, 5), (2, 11)])
def test_trie_equals_a_plain_one(spark, width, range_rows):
    rows = made(width, 180) + [(None, 0, "user", "lost"), (7, 2, "user", "twice"), (7, 2, "user", "twice")]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], "conv_id long, turn long, role string, text string, depth int, k1 int, seg string").repartition(3)
    got = sorted((tuple(r) for r in prefix_trie.trie(df, width=width, range_rows=range_rows).collect()), key=str)
    want = plain(rows)
    # Turns of one number with different role or text may come in another order than the plain one's; here there are none.
    assert got == want


def test_edges_of_the_trie(spark):
    kind = "conv_id long, turn long, role string, text string"
    assert prefix_trie.trie(spark.createDataFrame([], kind)).count() == 0
    assert prefix_trie.trie(spark.createDataFrame([(None, 1, "a", "b")], kind)).count() == 0
    c = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 >= 2)  # its base is absent: left without a turn
    one = prefix_trie.trie(spark.createDataFrame([(c, None, None, None)], kind)).collect()
    assert [tuple(r) for r in one] == [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]
    long = "x" * 300_000
    two = prefix_trie.trie(spark.createDataFrame([(100, 1, "u", long), (200, 1, "u", long)], kind)).collect()
    assert sorted((r.depth, r.n_convs, r.saved_tokens) for r in two) == [(0, 2, 300_000), (1, 2, 300_000)]


def test_a_long_list_of_ends_is_digested_piece_by_piece(spark):
    rows = [(100 * k, 0, "u", "same") for k in range(3000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.depth: r for r in prefix_trie.trie(df, range_rows=500).collect()}
    assert got[1].ends_sha256 == hashlib.sha256(",".join(str(100 * k) for k in range(3000)).encode()).hexdigest() and got[1].n_convs == 3000
