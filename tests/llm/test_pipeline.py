import pytest

import brute
import corpus_pipeline
from brute import SF
from test_lines import brute as brute_lines

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The documents before the first stage and after each."""
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(str(folder / name))
        docs = spark.read.parquet(str(folder / name))
        out.append(docs)
    return out


def rows(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()]


def test_columns_stay(stages):
    for df in stages[:-1]:
        assert df.columns == COLUMNS
        assert all(n == len(t) for t, n in rows(df, "text", "n_chars"))


def test_quality_stage(stages):
    before, after = stages[0], stages[1]
    told = brute.quality(rows(before, "doc_id", "text", "source"))
    assert {r[0] for r in told if r[-1]} == {d for (d,) in rows(after, "doc_id")}
    texts = dict(rows(before, "doc_id", "text"))
    for d, t in rows(after, "doc_id", "text"):
        assert set(t.split("\n")) <= set(texts[d].split("\n"))


def test_line_stage(stages):
    before, after = stages[1], dict(rows(stages[2], "doc_id", "text"))
    told = brute_lines(rows(before, "doc_id", "text"))
    want = {}
    for d, t in rows(before, "doc_id", "text"):
        rest = "\n".join(x for i, x in enumerate(t.split("\n")) if i not in told[d][1])
        if not told[d][1] or brute.BLANK.search(rest):
            want[d] = rest
    assert after == want


def test_near_duplicate_stage(stages):
    told = brute.components(rows(stages[2], "doc_id", "text"))
    assert {d for (d,) in rows(stages[3], "doc_id")} == {d for d, (n, c) in told.items() if d == c}


def test_benchmark_stage(spark, stages):
    items = rows(spark.read.parquet(f"{SF}/benchmark.parquet"), "item_id", "text")
    told = brute.contamination(rows(stages[3], "doc_id", "text"), items)
    assert {d for (d,) in rows(stages[4], "doc_id")} == {r[0] for r in told if not r[-1]}


def test_mix_stage(stages):
    from ledgerloom.llm import mixing

    docs = {d: (s, len(brute.BLANK.findall(t))) for d, s, t in rows(stages[4], "doc_id", "source", "text")}
    sources = sorted({s for s, _ in docs.values()})
    size = {s: sum(n for x, n in docs.values() if x == s) for s in sources}
    want = mixing.targets([size[s] for s in sources], [(5, 2, 1)[i % 3] for i in range(len(sources))], sum(size.values()), 3)
    took, per = dict.fromkeys(sources, 0), {}
    for d, s, n in rows(stages[5], "doc_id", "source", "n_words"):
        took[s] += n
        per[d] = per.get(d, 0) + n
    assert all(abs(took[s] - t) <= max(2, size[s] / 500) for s, t in zip(sources, want))
    assert all(n <= 3 * docs[d][1] for d, n in per.items())


def test_run_is_the_stages_in_turn(spark, stages):
    got = rows(corpus_pipeline.run(spark, SF), "doc_id", "copy", "first_word", "n_words", "shard")
    assert sorted(got) == sorted(rows(stages[-1], "doc_id", "copy", "first_word", "n_words", "shard"))


def test_empty_table(spark, tmp_path):
    spark.read.parquet(f"{SF}/documents.parquet").limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
