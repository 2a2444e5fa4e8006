"""Prefix trie against a plain dictionary of prefixes."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from stmtscope.llm import prefix_trie as pt
from stmtscope.llm.queries import op12_prefix_trie

ROWS = "conv_id long, turn long, role string, text string"


def rebuilt(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts, key=lambda t: t[:2])] for c, ts in turns.items()}
    result = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        result[c] = own.get(c - c % 20, [])[:h] + ts[h:]
    return result


def brute(convs):
    members, ends = defaultdict(list), defaultdict(list)
    for c, ts in convs.items():
        for d in range(len(ts) + 1):
            members[tuple(ts[:d])].append(c)
        ends[tuple(ts)].append(c)
    children = defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, cs in members.items():
        own = (len(cs) - 1) * len(p[-1][1].encode().split()) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += children[p] == 0
            saved[p[:d]] += own
    return sorted(
        (
            min(cs), len(p), min(members[p[:-1]]) if p else None, len(cs), children[p], leaves[p], saved[p],
            hashlib.sha256(",".join(map(str, sorted(ends.get(p, [])))).encode()).hexdigest(),
        )
        for p, cs in members.items()
    ) if convs else []


def trie_rows(df):
    return sorted(map(tuple, df.collect()), key=lambda r: (r[0], r[1]))


def conversations(seed, n, depth, choices):
    rng = random.Random(seed)
    return [
        (c, t, rng.choice(["user", "system"]) if t % 2 else "user", " ".join(["word"] * rng.randint(0, choices)))
        for c in rng.sample(range(3 * n), n)
        for t in range(rng.randint(1, depth))
    ]


@pytest.mark.parametrize("limits", [(8192, 1 << 18), (4, 1000), (2, 3), (1, 1)])
def test_against_dictionary(spark, tmp_path, limits):
    rows = conversations(5, 120, 7, 2)
    # Copies, copies that go on, and long ones that part late.
    rows += [(c, t, "user", f"same {t}") for c in range(1000, 1030) for t in range(5)]
    rows += [(c, t, "user", f"same {t}") for c in range(1030, 1034) for t in range(c - 1025)]
    rows += [(c, t, "user", "long" if t < 59 else f"tail {c}") for c in range(2000, 2006) for t in range(60)]
    frame = spark.createDataFrame(rows, ROWS)
    shared = pt.F.crc32(pt.F.col("conv_id").cast("string").cast("binary")) % 4
    convs = pt.with_shared_openings(pt.sequences(frame), 20, shared)
    assert trie_rows(pt.prefix_trie(spark, convs, *limits)) == brute(rebuilt(rows))


def test_without_shared_openings(spark):
    rows = conversations(9, 40, 5, 1)
    plain = defaultdict(list)
    for c, t, role, text in rows:
        plain[c].append((role, text))
    got = pt.prefix_trie(spark, pt.sequences(spark.createDataFrame(rows, ROWS)), 3, 10)
    assert trie_rows(got) == brute(plain)


def test_edges(spark, tmp_path):
    rows = [
        (None, 1, "user", "no conversation"),
        (1, None, "user", "first"), (1, 0, None, None), (1, 1, "user", ""), (1, 1, "user", ""),
        (2, 5, "a", "\x00 ü  x"), (2, 5, "a", "\x00 ü  x"), (40, 0, "u", "opening one"), (40, 1, "u", "opening two"),
        (41, 0, "u", "x"), (42, 3, "u", "y"), (43, 3, "u", "y"), (44, 3, "u", "y"), (45, -1, "u", " ".join(["long"] * 50_000)),
        (61, 0, "u", "shorter than its opening"), (62, 0, "u", "z"), (63, 0, "u", "z"), (64, 0, "u", "z"),
        (-7, 0, "u", "negative"), (-7, 1, "u", "negative"),
    ]
    extra = spark.createDataFrame([(*r, "x", 1) for r in rows], ROWS + ", path string, n long")
    extra.write.parquet(f"{tmp_path}/a/conversations.parquet")
    want = rebuilt([r for r in rows if r[0] != -7])
    # Remainders of negative numbers are negative, as in SQL.
    h = zlib.crc32(b"-7") % 4
    want[-7] = [("u", "negative")] * 2
    want[-7] = want[-7][h:]
    got = trie_rows(op12_prefix_trie(spark, f"{tmp_path}/a"))
    assert got == brute(want)
    spark.createDataFrame([], ROWS).write.parquet(f"{tmp_path}/b/conversations.parquet")
    assert op12_prefix_trie(spark, f"{tmp_path}/b").count() == 0


def test_a_sequence_of_many_conversations(spark):
    """The list of its conversations is digested over several ranges of numbers."""
    n = 150_000
    frame = spark.range(n).selectExpr("id as conv_id", "0L as turn", "'u' as role", "if(id = 7, 'other', 'same') as text")
    got = trie_rows(pt.prefix_trie(spark, pt.sequences(frame)))
    digest = hashlib.sha256(",".join(str(i) for i in range(n) if i != 7).encode()).hexdigest()
    other = hashlib.sha256(b"7").hexdigest()
    assert got == [
        (0, 0, None, n, 2, 2, n - 2, pt.NO_ENDS), (0, 1, 0, n - 1, 0, 1, n - 2, digest), (7, 1, 0, 1, 0, 1, 0, other),
    ]
