"""Reply trees against a plain walk."""

import random

import pytest

from packetloom.llm import chat

KIND = "conv_id string, msg_id long, parent_id long, role string, text string, score double, rank int"


def walk(rows, keep):
    """(conv, root id, leaf id, rank, turns) per chosen path."""
    single = {}
    for conv, mid, parent, role, text, score, _ in rows:
        content = ((parent is not None, parent or 0), role or "", text or "", score or 0.0)
        key = (conv, ("v", mid) if mid is not None else ("n", content))
        if key not in single or content < single[key][0]:
            single[key] = (content, parent, mid)
    answered = {(conv, ("v", p)) for (conv, _), (_, p, _) in single.items() if p is not None}
    trees = {}
    for key, (_, _, mid) in single.items():
        if key in answered:
            continue
        path, at, seen = [], key, set()
        while at is not None and at not in seen:
            seen.add(at)
            content, parent, _ = single[at]
            path.append(at)
            up = (key[0], ("v", parent))
            at = up if parent is not None and up in single else None
        if at is not None:
            continue  # round in circles
        total = sum(single[k][0][3] for k in path)
        turns = [single[k][0][1:3] for k in reversed(path)]
        trees.setdefault((key[0], path[-1]), []).append((-total, mid is None, mid or 0, turns, single[path[-1]][2], mid))
    out = []
    for (conv, _), leaves in trees.items():
        for rank, (_, _, _, turns, root, leaf) in enumerate(sorted(leaves, key=lambda x: x[:3]), 1):
            if keep is None or rank <= keep:
                out.append((conv, root, leaf, rank, turns))
    return sorted(out, key=repr)


def found(spark, rows, keep):
    df = spark.createDataFrame(rows, KIND).repartition(3)
    return sorted(((r.conv_id, r.root_id, r.leaf_id, r["rank"], chat.read_back(r.formatted)) for r in chat.format_trees(df, keep=keep).collect()), key=repr)


@pytest.mark.parametrize("keep", [1, 2, None])
def test_random_forests(spark, keep):
    rng = random.Random(8)
    rows = []
    for conv in ["", None, "n", "v", "a", "b"]:
        for mid in range(1, 40):
            parent = rng.choice([None, 99, rng.randrange(1, mid) if mid > 1 else None, rng.randrange(1, mid) if mid > 1 else None])
            rows.append((conv, mid, parent, rng.choice(["user", "assistant", None]), f"{conv} {mid}", rng.random() + mid, 0))
        rows.append((conv, None, 3, "user", f"no id {conv}", 0.5, 0))
        rows += [(conv, 50, 51, "user", "circle", 0.0, 0), (conv, 51, 50, "user", "circle", 0.0, 0), (conv, 52, 51, "user", "on a circle", 0.0, 0)]
    rows += rows[:60] + [(rows[3][0], rows[3][1], 38, "zzz", "a second message of one id", 9.0, 0)]
    assert found(spark, rows, keep) == walk(rows, keep)


def test_empty_and_missing_ids_are_two_conversations(spark):
    rows = [("", 1, None, "user", "q", 0.0, 0), ("", 2, 1, "assistant", "a", 0.0, 0), (None, 1, None, "user", "r", 0.0, 0), (None, 2, 1, "assistant", "b", 0.0, 0)]
    want = [("", 1, 2, 1, [("user", "q"), ("assistant", "a")]), (None, 1, 2, 1, [("user", "r"), ("assistant", "b")])]
    assert found(spark, rows * 3, 1) == sorted(want, key=repr)
    assert found(spark, rows[:1] * 5, None) == [("", 1, 1, 1, [("user", "q")])]


def test_branches_and_trees_have_rows_of_their_own(spark):
    rows = [("c", 1, None, "user", "q", 0.0, 0), ("c", 2, 1, "assistant", "A", 2.0, 0), ("c", 3, 1, "assistant", "B", 1.0, 0), ("c", 4, 77, "user", "orphan", 0.0, 0)]
    best = [("c", 1, 2, 1, [("user", "q"), ("assistant", "A")]), ("c", 4, 4, 1, [("user", "orphan")])]
    assert found(spark, rows, 1) == sorted(best, key=repr)
    assert found(spark, rows, None) == sorted([*best, ("c", 1, 3, 2, [("user", "q"), ("assistant", "B")])], key=repr)
