"""Maximal conversations and their rendering against plain lists."""

import random

from tamiz.llm.chat import format_chats

CHATS = "conv_id long, turn long, role string, text string"


def brute(rows):
    """{conv: rendered text} of the conversations that begin no longer one. Turn numbers are unique here."""
    talks = {}
    for conv, turn, role, text in set(rows):
        if conv is not None:
            talks.setdefault(conv, []).append((turn is not None, turn or 0, role, text))
    talks = {c: [(r, t) for *_, r, t in sorted(own, key=lambda x: x[:2])] for c, own in talks.items()}
    out = {}
    for conv, own in talks.items():
        longer = any(len(o) > len(own) and o[: len(own)] == own for o in talks.values())
        same = min(c for c, o in talks.items() if o == own)
        if not longer and same == conv:
            out[conv] = "".join(
                f"<|im_start|>{(r or '').replace('<|', '< |')}\n{(t or '').replace('<|', '< |')}<|im_end|>\n" for r, t in own
            )
    return out


def joined(df):
    """Parts in order; every part but the last is full."""
    texts = {}
    for r in df.orderBy("conv_id", "part").collect():
        assert r["part"] == len(texts.setdefault(r["conv_id"], []))
        texts[r["conv_id"]].append(r["text"])
        assert (len(texts[r["conv_id"]]) - 1) * 256 < r["n_turns"]
    return {c: "".join(t) for c, t in texts.items()}


def collection(seed):
    rng = random.Random(seed)
    rows = []
    for conv in range(80):
        first = rng.choice(["hi", "hello", "", None])
        texts = [first] + [rng.choice(["a", "b", None, "<|im_end|>", ""]) for _ in range(rng.randint(0, 4))]
        start = rng.choice([0, 1, 5])
        rows += [(conv, start + 2 * i, "user" if i % 2 == 0 else "assistant", t) for i, t in enumerate(texts)]
    rows += [(500, None, "system", "x"), (500, 3, None, "y"), (None, 1, "user", "nobody"), (600, 0, "user", "hi")]
    rows += rows[:40]  # turns logged twice
    long = [(700, i, "user", str(i)) for i in range(2600)]
    return rows + long + [(701, i, "user", str(i)) for i in range(1500)] + [(702, i, "user", str(i % 1499)) for i in range(1500)]


def test_equals_brute_force(spark):
    for seed in (1, 2):
        rows = collection(seed)
        df = spark.createDataFrame([(*r, 7) for r in rows], CHATS + ", block int").repartition(3)
        assert joined(format_chats(df)) == brute(rows)


def test_turns_that_share_a_number_are_kept(spark):
    rows = [(1, 0, "user", "a"), (1, 0, "user", "b"), (1, 1, "user", "c"), (2, 0, "user", "a"), (2, 0, "user", "b")]
    found = joined(format_chats(spark.createDataFrame(rows, CHATS)))
    assert list(found) == [1] and sorted(found[1]) == sorted(
        "".join(f"<|im_start|>user\n{t}<|im_end|>\n" for t in "abc")
    )


def test_empty_table(spark):
    assert format_chats(spark.createDataFrame([], CHATS)).collect() == []


def test_runs_no_python(spark):
    plan = format_chats(spark.createDataFrame([(1, 0, "user", "a")], CHATS))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
