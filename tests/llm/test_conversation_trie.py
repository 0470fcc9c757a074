"""The trie of conversations against a dictionary of prefixes."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest

from lakepulse.llm import conversation_trie as ct

SCHEMA = "conv_id long, turn long, role string, text string, depth long, a string, base string"


def brute(rows, every=100, heads=6):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append(((turn is not None, turn or 0), role or "", text or ""))
    convs = {c: [t[1:] for t in sorted(ts)] for c, ts in convs.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % heads
        rebuilt = convs.get(c - int(np.fmod(c, every)), [])[:h] + own[h:]
        for d in range(len(rebuilt) + 1):
            members[tuple(rebuilt[:d])].append(c)
        ends[tuple(rebuilt)].append(c)
    out, children = [], defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    totals = {}
    for node in sorted(members, key=len, reverse=True):
        leaves, saved = (0, 0) if children[node] else (1, 0)
        saved += (len(members[node]) - 1) * len(node[-1][1]) if node else 0
        for child in children[node]:
            leaves, saved = leaves + totals[child][0], saved + totals[child][1]
        totals[node] = leaves, saved
        digest = hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest()
        out.append((min(members[node]), len(node), min(members[node[:-1]]) if node else None, len(members[node]), len(children[node]), leaves, saved, digest))
    return sorted(out, key=str)


def conversations(seed, n=400):
    """Few different turns, so that conversations share prefixes or are equal; gaps, nulls, ties, repeated rows, negative and large ids."""
    rng = np.random.default_rng(seed)
    rows = []
    for c in [*range(n), -5, -100, -150, 10**15, 10**15 + 3, 777_700, 777_701, 123_456]:
        for turn in range(int(rng.integers(0, 9))):
            rows.append((c, None if rng.random() < 0.05 else turn, str(rng.choice(["user", "bot"])) if rng.random() < 0.9 else None, str(rng.choice(["", "a", "é中🙂", "b" * 50])) if rng.random() < 0.95 else None))
    rows += [(777_700, 0, "user", "x"), (777_700, 0, "user", "x"), (None, 1, "user", "of nobody"), (None, None, None, None)]
    rows += [(500, t, "user", f"long {t % 3}") for t in range(900)] + [(520, t, "user", f"long {t % 3}") for t in range(700)]
    return rows


def found(df):
    return sorted((tuple(r) for r in df.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_trie(spark, seed, monkeypatch):
    if seed == 2:
        monkeypatch.setattr(ct, "CHUNK_BITS", 2)
    rows = conversations(seed)
    df = spark.createDataFrame([(*r, 1, "clash", None) for r in rows], SCHEMA).repartition(3)
    assert found(ct.conversation_trie(df)) == brute(rows)


def test_one_conversation_over_many_ranges(spark):
    """A conversation that has nearly all turns, and its copy, lie in several ranges of the order; ids of equal conversations are hashed in order."""
    rows = [(c, t, "user", f"t{t}") for c in (1, 2) for t in range(1500)] + [(c, 0, "user", "same") for c in range(1000, 1090)]
    df = spark.createDataFrame([(*r, 1, "", "") for r in rows], SCHEMA)
    turns = ct.ordered_turns(df)
    assert turns.where("conv_id = 1").selectExpr(f"count(distinct shiftright(seq, {ct.PLACE_BITS})) as n").first().n > 1
    assert found(ct.conversation_trie(df)) == brute(rows)


def test_turnless_and_empty(spark):
    rows = [(c, 0, None, "one") for c in range(50, 60)]
    want = brute(rows)
    assert found(ct.conversation_trie(spark.createDataFrame([(*r, 1, "", "") for r in rows], SCHEMA))) == want and want[0][1] == 0
    assert ct.conversation_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    assert ct.conversation_trie(spark.createDataFrame([(None, 1, "a", "b", 1, "", "")], SCHEMA)).count() == 0


def test_query_over_all_conversations(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found(ct.op12_conversation_trie(spark, sf)) == brute(rows)
