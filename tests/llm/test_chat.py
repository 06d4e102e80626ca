from pyspark.sql import functions as F

from lacuna.llm import chat as C
from lacuna.llm import queries
from lacuna.llm.oracle import ORACLE
from tests.llm.conftest import duck, same

ROWS = [(1, 0, "ann", "hi"), (1, 1, "bob", "hello é"), (1, 2, "ann", ""), (1, 2, "ann", ""), (1, 3, "cy", None), (1, None, "bob", "late"),
        (2, 0, "user", "x" * 5000), (2, 70, None, "far"), (2, 64, "user", "tie"), (2, 64, "assistant", "tie"), (None, 0, "ann", "lost"), (3, 0, None, None)]
SCHEMA = "conv_id long, turn long, role string, text string"


def table(spark, rows=ROWS):
    return spark.createDataFrame(rows, SCHEMA)


def test_by_hand(spark):
    r = C.perspectives(table(spark).filter("conv_id = 1")).filter("speaker = 'ann' and block = 0").collect()[0]
    assert r.text == ("<|im_start|>assistant\nhi<|im_end|>\n<|im_start|>user name=bob\nhello é<|im_end|>\n<|im_start|>assistant\n<|im_end|>\n"
                      "<|im_start|>user name=cy\n<|im_end|>\n")
    assert [r.text[m.start:m.end] for m in r.mask] == ["hi<|im_end|>", "<|im_end|>"]
    assert (r.n_turns, r.n_rows) == (4, 5)


def test_equal_to_sql(spark, tmp_path):
    table(spark).withColumn("speaker", F.lit(1)).write.parquet(str(tmp_path / "conversations.parquet"))
    same(queries.op6_chat_perspectives(spark, str(tmp_path)), duck({"conversations": table(spark)}, ORACLE["op6_chat_perspectives"]))


def test_crowded_turn_stands_in_parts(spark):
    rows = [(1, 5, "ann", f"t{i}") for i in range(200)] + [(1, 4, "bob", "x"), (1, 6, "bob", "y")] + [(1, None, "bob", f"n{i}") for i in range(100)]
    found = C.perspectives(table(spark, rows)).filter("speaker = 'bob'").collect()
    assert sum(r.n_turns for r in found) == 302 and max(r.n_turns for r in found) < 150
    text = "".join(r.text for r in found)
    assert all(f"\n{t}<|im_end|>" in text for _, _, _, t in rows)
    assert sum(len(r.mask) for r in found) == 102


def test_empty(spark):
    assert C.perspectives(table(spark, [])).count() == 0
