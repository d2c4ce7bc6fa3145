"""What one row may hold: many turns, spans and lines, and columns of any name."""

import hashlib
import time

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import chat, decontaminate, jaccard, language, lines, native, quality, secrets, suffixes

MANY = 100_000
#: Names that the operators use inside, now or in earlier versions, and one with a dot.
NAMES = """_id _own _cut _fp _all _at _chars _host _text _digest _kinds _no _0 _1 id of fp host n cut all at raw norm line
pos chars digest kinds copied runs found low order every no label part h s0 base a.b""".split()


@pytest.fixture(scope="module")
def clashing(spark):
    rows = [(1, "same words all over again in this text here\n" * 3, "s"), (1, None, None), (None, "", "s"), (2, "word " * 300, "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    return docs.select("*", *[F.lit(f"own {c}").alias(c) for c in NAMES])


ADDED = {
    "judge": (quality.judge, {"base"}),
    "clean": (quality.clean, set()),
    "mark_repeats": (lines.mark_repeats, {"cut"}),
    "drop_repeats": (lines.drop_repeats, set()),
    "keep_first": (jaccard.keep_first, set()),
    "find_secrets": (secrets.find_secrets, set()),
    "cut_repeats": (suffixes.cut_repeats, {"copied", "runs"}),
    "predict": (lambda docs: language.predict(docs, None), set()),
    "predict_learnt": (lambda docs: language.predict(docs, language.train(docs.select("text", F.lit("en").alias("lang")))), set()),
}


@pytest.mark.parametrize("name", ADDED)
def test_columns_of_any_name(clashing, name):
    operator, replaced = ADDED[name]
    out = operator(clashing)
    stay = [c for c in clashing.columns if c not in replaced]
    assert [c for c in out.columns if c in stay] == stay
    for row in out.select(*[F.col(f"`{c}`") for c in NAMES if c not in replaced]).collect():
        assert list(row) == [f"own {c}" for c in NAMES if c not in replaced]


def test_contamination_with_columns_of_any_name(spark, clashing):
    items = spark.createDataFrame([("q", "same words all over again in this text here")], "item_id string, text string")
    marked = decontaminate.mark_contaminated(clashing, items)
    names = [c for c in NAMES if c != "found"]
    assert {tuple(r) for r in marked.select(*[F.col(f"`{c}`") for c in names]).collect()} == {tuple(f"own {c}" for c in names)}
    assert sorted(r["n_hit"] for r in marked.collect()) == [0, 0, 0, 27]
    assert decontaminate.decontaminate(clashing, items).columns == clashing.columns


def test_running_sums(spark):
    rows = [(k, [(7 * i) % 11 for i in range(k)]) for k in (0, 1, 2, 3, 8, 9, 27, 100, 1001)]
    df = spark.createDataFrame(rows, "k int, a array<int>")
    for k, a, got, rest in df.select("k", "a", native.running(F.col("a")), native.without(F.col("a"), F.array(F.lit(0), F.lit(2)))).collect():
        assert got == [sum(a[:i]) for i in range(k)] and rest == [x for i, x in enumerate(a) if i not in (0, 2)]


def test_a_conversation_of_many_turns(spark):
    role = F.when(F.col("id") % 3 == 0, "user").otherwise("assistant")
    turns = spark.range(MANY).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), F.concat(F.lit("é <b> "), F.col("id")).alias("text"))
    start = time.time()
    got = chat.chat_digest(chat.format_chats(turns)).first()
    assert time.time() - start < 60
    learnt = "".join(f"é <b> {i}" for i in range(MANY) if i % 3)
    assert got["n_turns"] == MANY and got["loss_sha256"] == hashlib.sha256(learnt.encode()).hexdigest() and got["loss_chars"] == len(learnt)


def test_a_text_of_many_secrets(spark):
    text = "".join(f"é {hashlib.md5(str(i).encode()).hexdigest()}" for i in range(MANY))
    start = time.time()
    spans = secrets.find_secrets(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()["secrets"]
    assert time.time() - start < 60
    assert [(s["start"], s["end"]) for s in spans if s["kind"] == "hex"] == [(34 * i + 2, 34 * i + 34) for i in range(MANY)]


def test_a_text_of_many_lines(spark):
    text = "one line that is equal to all the other lines\n" * MANY + "and one that is not, at the very end"
    docs = spark.createDataFrame([(i, text, "s") for i in range(2)], "doc_id long, text string, source string")
    start = time.time()
    assert [r["text"].count("\n") for r in lines.drop_repeats(docs).collect()] == [1]
    docs = docs.withColumn("text", F.concat("text", F.sha2(F.col("doc_id").cast("string"), 256)))
    got = quality.clean(docs, most_docs=1, least_left=0, least_chars=0, most_repeated=101).collect()
    assert time.time() - start < 90
    assert len(got) == 2 and all("\n" not in r["text"] and r["text"].startswith("and one") for r in got)
