import random
from collections import defaultdict

import duckdb
from pyspark.sql import functions as F

from layerloom.llm import preference
from layerloom.llm.queries import op4_preference
from layerloom.llm.sql import PREFERENCE_SQL
from tests.oracle import spark_result, sql_result

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def _plain(chosen, rejected, learnt=("assistant",)):
    sides = []
    for rows in (chosen, rejected):
        of = defaultdict(list)
        for conv, turn, role, text in rows:
            if conv is not None:
                of[conv].append((turn is not None, turn or 0, role or "", text or ""))
        sides.append({k: [t[2:] for t in sorted(v)] for k, v in of.items()})
    out = {}
    for conv in sides[0].keys() & sides[1].keys():
        c, r = sides[0][conv], sides[1][conv]
        n = 0
        while n < min(len(c), len(r)) and c[n] == r[n]:
            n += 1
        parts = []
        for turns in (c[n:], r[n:]):
            text, mask = "", []
            for role, words in turns:
                text += f"<|{role}|>\n"
                if role in learnt:
                    mask.append((len(text), len(text) + len(words) + len("<|end|>\n")))
                text += f"{words}<|end|>\n"
            parts.append((text, mask))
        prompt = "".join(f"<|{role}|>\n{words}<|end|>\n" for role, words in c[:n])
        out[conv] = (n, prompt, *parts)
    return out


def _rows(df):
    return {
        r.pair: (
            r.prompt_turns, r.prompt, (r.chosen, [tuple(s) for s in r.chosen_mask]), (r.rejected, [tuple(s) for s in r.rejected_mask])
        )
        for r in df.collect()
    }


def test_against_plain_form(spark):
    rng = random.Random(1)
    sides = ([], [])
    for conv in range(200):
        for side in sides:
            for turn in range(rng.randint(0, 6)):
                side.append((conv, turn, rng.choice(["user", "assistant"]), rng.choice(["a", "ü", "日本\n"])))
    for side in sides:
        rng.shuffle(side)
    got = _rows(preference.preference_pairs(*[spark.createDataFrame(s, SCHEMA) for s in sides]))
    assert got == _plain(*sides)
    assert {v[0] for v in got.values()} >= {0, 1, 2}


def test_masks_mark_what_the_assistant_says(spark):
    turns = [(1, 0, "user", "q"), (1, 1, "assistant", "good"), (1, 2, "user", "and?"), (1, 3, "assistant", "more")]
    other = [*turns[:1], (1, 1, "assistant", "bad")]
    r = preference.preference_pairs(*[spark.createDataFrame(s, SCHEMA) for s in (turns, other)]).first()
    assert r.prompt == "<|user|>\nq<|end|>\n"
    assert [r.chosen[s.start : s.end] for s in r.chosen_mask] == ["good<|end|>\n", "more<|end|>\n"]
    assert [r.rejected[s.start : s.end] for s in r.rejected_mask] == ["bad<|end|>\n"]


def test_edge_cases(spark):
    long = "x" * 300_000
    chosen = [
        (1, 0, None, None), (1, 1, "assistant", ""), (2, 0, "user", "same"), (3, 0, "user", "only here"), (None, 0, "user", "x"),
        (4, None, "user", "no number"), (4, 0, "user", "no number"), (5, 0, "user", "twice"), (5, 0, "user", "twice"), (6, 0, "assistant", long),
    ]
    rejected = [
        (1, 0, "", ""), (2, 7, "user", "same"), (4, 5, "assistant", "z"), (5, 0, "user", "twice"), (6, 1, "assistant", long + "y"), (None, 0, "user", "x"),
    ]
    frames = [spark.createDataFrame(s, SCHEMA).withColumns({"pair": F.lit(1), "c": F.lit(2)}) for s in (chosen, rejected)]
    got = _rows(preference.preference_pairs(*frames))
    assert got == _plain(chosen, rejected)
    assert got[2][2:] == (("", []), ("", []))


def test_other_tails(spark):
    """The n-th conversation keeps n modulo its length turns and goes on like the next."""
    turns = [
        (1, 0, "user", "a"), (1, 1, "assistant", "b"), (1, 1, "assistant", "b"), (5, None, "user", None), (5, 4, "assistant", "c"),
        (9, 3, "assistant", "d"), (9, 4, "user", "e"), (9, 9, None, "f"), (9, 10, "user", "g"), (None, 0, "user", "x"),
    ]
    got = sorted(tuple(r) for r in preference.with_other_tail(spark.createDataFrame(turns, SCHEMA)).collect())
    assert got == [
        (1, 0, "user", "a"), (1, 1, "assistant", "c"),
        (5, 0, "assistant", "d"), (5, 1, "user", "e"), (5, 2, "", "f"), (5, 3, "user", "g"),
        (9, 0, "assistant", "d"), (9, 1, "user", "e"), (9, 2, "", "f"),
    ]


def test_query_has_prompts_of_many_lengths(spark, sf_dir):
    rows = op4_preference(spark, sf_dir).collect()
    assert len({r.prompt_turns for r in rows}) >= 4
    assert any("," in r.chosen_mask for r in rows) and any("," in r.rejected_mask for r in rows)


def test_sql_treats_null_and_repeated_turns_alike(spark, tmp_path):
    """The query and its SQL on turns with NULL numbers, repeats and ties."""
    rng = random.Random(8)
    rows = []
    for conv in [None, *range(60)]:
        for _ in range(rng.randint(1, 7)):
            row = (conv, rng.choice([None, 0, 1, 2, 3]), rng.choice(["user", "assistant", None]), rng.choice(["a", "b", None, "ü"]))
            rows += [row] * rng.choice([1, 1, 1, 2])
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "conversations.parquet"))
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    assert spark_result(op4_preference(spark, str(tmp_path))) == sql_result(con, PREFERENCE_SQL)


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert preference.preference_pairs(empty, empty).collect() == []
    assert preference.with_other_tail(empty).collect() == []
