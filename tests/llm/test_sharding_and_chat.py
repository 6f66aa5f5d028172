from __future__ import annotations

import hashlib
import zlib
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from scdstar.llm import chat, sharding
from scdstar.llm.queries import op10_reply_trees

from awkward import awkward, docs, none  # noqa: F401


def check_shards(rows, expected) -> dict[int, int]:
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in expected
    )
    slots, size = defaultdict(list), defaultdict(int)
    for r in rows:
        assert 0 <= r.shard < 8
        slots[r.shard].append(r.slot)
        size[r.shard] += r.size
    for found in slots.values():
        assert sorted(found) == list(range(len(found)))
    return size


def test_awkward_rows_get_one_slot_each(docs, none):
    check_shards(sharding.shard(docs).collect(), awkward())
    assert sharding.shard(none).count() == 0
    blank = docs.filter("text IS NULL")
    check_shards(sharding.shard(blank).collect(), [(i, t) for i, t in awkward() if t is None])


def test_a_group_of_a_third_of_the_rows_is_subdivided(spark):
    rows = [(k, "copy " * 20 if k % 3 == 0 else f"text {k} " * (k % 40)) for k in range(6000)]
    found = sharding.shard(spark.createDataFrame(rows, "doc_id bigint, text string"), pieces=256).collect()
    size = check_shards(found, rows)
    fair = sum(size.values()) / 8
    assert len(size) == 8 and all(abs(s - fair) < 0.04 * fair for s in size.values())
    small = [r for r in found if r.doc_id % 3]
    assert sharding.shard(  # the same again, whatever the partitions
        spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7), pieces=256
    ).filter("doc_id % 3 > 0").select("doc_id", "shard").collect().__len__() == len(small)


TEXT = st.lists(
    st.sampled_from([*"\\<|>n\n#/ aturnd", "<|end|>\n", "<|turn|>", "\\|", "é🙂"]), max_size=30
).map("".join)


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(TEXT, TEXT), min_size=1, max_size=30))
def test_escapes_are_reversible_and_hide_marks(spark, pairs):
    rows = [(1, k, k - 1 if k else None, r, t, 0.0) for k, (r, t) in enumerate(pairs)]
    messages = spark.createDataFrame(rows, chat_schema).coalesce(1)
    row = chat.parsed(chat.formatted(messages)).collect()[0]
    assert [tuple(t) for t in row.turns] == pairs


chat_schema = "tree bigint, node bigint, parent bigint, role string, text string, score double"


def brute_paths(rows) -> dict[tuple, list[int]]:
    """All root-to-leaf paths by walking up."""
    parent = {(t, n): p for t, n, p, *_ in rows}
    inner = {(t, p) for t, n, p, *_ in rows if (t, p) in parent}
    out = {}
    for tree, leaf in parent:
        if (tree, leaf) not in inner:
            path, at = [], leaf
            while at is not None and (tree, at) in parent and len(path) <= len(parent):
                path.append(at)
                at = parent[tree, at]
            if len(path) <= len(parent):
                out[tree, leaf] = path[::-1]
    return out


def test_paths_of_trees(spark):
    import random

    random.seed(4)
    rows = []
    for tree in range(12):
        for node in range(random.randint(1, 60)):
            parent = random.randint(0, node - 1) if node and random.random() < 0.95 else None
            rows.append((tree, node, parent, "user", f"t{node}", random.random()))
    rows += [(50, 1, 2, "user", "cycle", 1.0), (50, 2, 1, "user", "cycle", 1.0)]
    rows += [(51, 5, 99, "user", "orphan", 1.0), (None, 1, None, "user", "", 0.0)]
    rows += [(52, k, k - 1 if k else None, "user", "chain", None) for k in range(700)]
    messages = spark.createDataFrame(rows, chat_schema).repartition(3)
    expected = brute_paths([r for r in rows if r[0] is not None and r[0] != 50])
    found = defaultdict(dict)
    for r in chat.paths(messages, None).collect():
        found[r.tree, r.leaf][r.place] = r.node
    assert {k: [v[i] for i in range(len(v))] for k, v in found.items()} == expected

    score = {(t, n): s or 0.0 for t, n, _, _, _, s in rows}
    best = {}
    for (tree, leaf), path in expected.items():
        mean = sum(score[tree, n] for n in path) / len(path)
        best.setdefault((tree, path[0]), []).append((-mean, leaf))
    for n in (1, 2):
        chosen = {(r.tree, r.leaf) for r in chat.paths(messages, n).select("tree", "leaf").collect()}
        assert chosen == {(t, leaf) for (t, _), found in best.items() for _, leaf in sorted(found)[:n]}


def test_masks_cover_assistant_texts(spark):
    rows = [(1, 0, None, "user", "a<|b", 0.0), (1, 1, 0, "assistant", "x\\y<|end|>\nz🙂", 0.0),
            (1, 2, 1, None, None, 0.0), (1, 3, 2, "assistant", "", 0.0), (1, 4, 3, "assistant", "end", 0.0)]
    found = chat.formatted(spark.createDataFrame(rows, chat_schema))
    row = found.withColumn("said", chat.loss_text(F.col("formatted"), F.col("loss"))).collect()[0]
    spans = [row.formatted[s.start : s.start + s.length] for s in row.loss]
    assert [s.replace("\\\\", "\0").replace("\\|", "|").replace("\0", "\\") for s in spans] == [
        "x\\y<|end|>\nz🙂", "", "end"
    ]
    assert row.said == "x\\y<|end|>\nz🙂end"


def test_query_on_awkward_conversations(spark, tmp_path):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", "a"), (1, 1, "assistant", "b"), (2, None, "user", None),
            (3, 5, None, "x\ny"), (None, 0, "user", "lost"), (4, 0, "system", "only")]
    spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn(
        "tree", F.lit("clash")
    ).write.parquet(f"{tmp_path}/conversations.parquet")
    found = {r.conv_id: r for r in op10_reply_trees(spark, str(tmp_path)).collect()}
    assert set(found) == {1, 2, 3, 4, -7}

    def digest(*turns):
        return hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()

    hard = r"\### Assistant: </turn> ok"
    assert found[1].turns_sha256 == digest(("user", "a"), ("assistant", "b"), ("assistant", "b"))
    assert found[2].turns_sha256 == digest(("user", ""))
    assert found[3].turns_sha256 == digest(("", "x\ny"))
    assert found[-7].turns_sha256 == digest(("user", hard), ("assistant", hard))
    assert found[-7].loss_sha256 == hashlib.sha256(hard.encode()).hexdigest()
    assert (found[1].n_turns, found[1].loss_chars, found[4].loss_chars) == (3, 2, 0)
