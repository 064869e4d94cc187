from __future__ import annotations

import hashlib
import random
import re
import zlib

from tidemark.llm import conversation_trie as C
from tidemark.llm.radix_tree import Direct, Indexed, RadixTree, Sorted

SCHEMA = "conv_id long, turn long, role string, text string, node int, words string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def tie(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()


def brute(rows):
    """Every prefix of every rebuilt conversation in a dictionary."""
    told = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            told.setdefault(conv, []).append((turn, role or "", text or ""))
    for conv, turns in told.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, tie(t[1], t[2])))
        told[conv] = [t[1:] for t in turns]
    whole = {}
    for conv, turns in told.items():
        first = conv - (abs(conv) % 20) * (1 if conv >= 0 else -1)
        h = zlib.crc32(str(conv).encode()) % 4
        whole[conv] = tuple(told.get(first, [])[:h] + turns[h:])
    members = {}
    for conv in sorted(whole):
        for d in range(len(whole[conv]) + 1):
            members.setdefault(whole[conv][:d], []).append(conv)
    children = {}
    for start in members:
        if start:
            children.setdefault(start[:-1], []).append(start)
    leaves, saved = {}, {}
    for start in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", start[-1][1])) if start else 0
        below = children.get(start, [])
        leaves[start] = sum(leaves[b] for b in below) if below else 1
        saved[start] = sum(saved[b] for b in below) + (len(members[start]) - 1) * words
    return sorted(
        (
            m[0], len(s), members[s[:-1]][0] if s else None, len(m), len(children.get(s, [])), leaves[s], saved[s],
            sha(",".join(str(c) for c in m if len(whole[c]) == len(s))),
        )
        for s, m in members.items()
    )


def check(spark, rows, parts=5):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(parts)
    got = C.conversation_trie(df)
    assert got.columns == C.COLUMNS and [t for _, t in got.dtypes] == ["bigint"] * 7 + ["string"]
    want = brute(rows)
    got = sorted(map(tuple, got.collect()))
    assert got == want
    return want


def dialogue(rng, size, starts):
    """Conversations that often go on as an earlier one began."""
    rows, said = [], [[]]
    for conv in range(size):
        begin = rng.choice(said)[: rng.randrange(6)] if rng.random() < 0.7 else []
        turns = begin + [(rng.choice("ab"), rng.choice(starts)) for _ in range(rng.randrange(6))]
        said.append(turns)
        rows += [(conv, at, role, text) for at, (role, text) in enumerate(turns)]
    return rows


def test_given_conversations(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    want = brute(rows)
    assert sorted(map(tuple, C.conversation_trie(table).collect())) == want


def test_shared_starts_in_many_small_trees(spark, monkeypatch):
    """Trees of few keys and pieces of few ids, so that most nodes are shared between trees."""
    rows = dialogue(random.Random(1), 400, ["one two", "one\x0bthree four", "", "x y z", "q"])
    rows += [(c, t, "a", f"hot {t}") for c in range(1000, 1120) for t in range(3)]
    monkeypatch.setattr(C, "TREE_BYTES", 700)
    monkeypatch.setattr(C, "PIECE_BYTES", 40)
    batches = sorted(keyed(rows))
    found = []
    for part in (batches[:150], batches[150:160], batches[160:]):
        b = C._Builder()
        for key, words, conv in part:
            b.take(key, words, conv)
        b.end_key(True)
        found += b.out
    assert sum(r[0] is not None and r[-1] is None for r in found) > 200
    table = spark.createDataFrame(found, C.FOUND_DDL)
    known = C._shared_nodes(table)
    own = table.filter("node IS NULL")
    whole = own.filter("parent IS NULL").select(*C.COLUMNS).unionByName(known.select(*C.COLUMNS))
    whole = whole.unionByName(C._with_parent(own.filter("parent IS NOT NULL"), known))
    assert sorted(map(tuple, whole.collect())) == brute(rows)


def keyed(rows):
    told = {}
    for conv, turn, role, text in rows:
        told.setdefault(conv, []).append((turn, tie(role, text), len(re.findall(r"[^\x20\x09-\x0D]+", text))))
    for conv, turns in told.items():
        h = zlib.crc32(str(conv).encode()) % 4
        t = sorted(told.get(conv - conv % 20, []))[:h] + sorted(turns)[h:]
        yield b"".join(i for _, i, _ in t), [w for _, _, w in t], conv


def test_nulls_ties_repeats_and_missing_heads(spark):
    rows = [(None, 0, "a", "lost"), (None, None, None, None)]
    rows += [(0, 1, "u", "second"), (0, None, "u", "first"), (0, 2, None, None), (0, 2, "u", "tie"), (0, 2, "u", "tie")]
    rows += [(c, 0, "u", "hello there") for c in range(1, 60)] + [(c, 1, "a", "x " * (c % 3)) for c in range(1, 60)]
    rows += [(-7, 0, "u", "minus"), (-20, 0, "u", "base"), (10**15, 0, "r:1", "a"), (10**15 + 1, 0, "r", "1:a")]
    check(spark, rows)


def test_long_conversations_and_hot_start(spark):
    rows = [(c, t, "u", f"turn {t}") for c in (1, 21, 41, 61) for t in range(150 + c)]
    rows += [(c, 0, "s", "the same system text") for c in range(100, 400)]
    rows += [(500, 0, "u", "w " * 200_000), (501, 0, "u", "w " * 200_000)]
    check(spark, rows)


def test_empty_table_and_one_turn(spark):
    assert check(spark, []) == []
    check(spark, [(3, 0, "u", "a b")])


def test_radix_tree_grows_and_compresses():
    rng = random.Random(2)
    for width in (3, 20, 60, 256):
        keys = sorted({bytes(rng.randrange(width) for _ in range(rng.randrange(1, 5))) for _ in range(600)})
        tree = RadixTree()
        for key in rng.sample(keys, len(keys)):
            tree.insert(key, key)
        tree.insert(keys[0], keys[0])
        found, kinds = [], set()
        ways = {}
        for node, parent, begin, own in tree.walk():
            way = (ways[id(parent)] if parent else b"") + own
            ways[id(node)] = way
            assert len(way) == begin + len(own)
            if node.value is not None:
                assert node.value == way
                found.append(way)
            if node is not tree.root:
                assert node.value is not None or len(list(node.layout.items())) > 1
            assert [b for b, _ in node.layout.items()] == sorted(b for b, _ in node.layout.items())
            kinds.add(type(node.layout))
        assert sorted(found) == keys
        assert {3: Sorted, 20: Indexed, 60: Direct, 256: Direct}[width] in kinds
