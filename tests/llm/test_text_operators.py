import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from brute import SF
from ledgerloom.llm import chat, decontaminate, language, mixing, quality, queries, secrets

ODD = [None, "", " \n\t ", "\n", "a", "x" * 5000, "é" * 300, "word " * 3000, "ab cd ef " * 40, "A b C", "€  \x85 \xa0"]
DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept string, size int, spans int"


def odd_docs(texts=ODD):
    rows = [(i, t, "en", None if i % 3 == 0 else f"s{i % 2}", None, "x", 1, 2) for i, t in enumerate(texts)]
    return rows + rows[:4] + [(None, "null id here", None, None, 3, None, None, None)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_docs(), DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def same(got, want):
    assert sorted(map(repr, got)) == sorted(map(repr, want))


# --- quality rules


def test_quality_on_the_small_table(spark, sf_rows):
    got = [tuple(r) for r in queries.op1_quality_rules(spark, SF).collect()]
    same(got, brute.quality(sf_rows("documents", "doc_id", "text", "source")))


def test_quality_removes_lines_of_many_documents(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(7))
    body = lambda n: " ".join(word() for _ in range(n))
    rows = []
    for i in range(60):  # a common line, in two hosts: over the limit in one only
        rows.append((i, f"{body(40)}\nAll Rights  reserved 20{i}!\n{body(40)}", "a" if i < 40 else "b"))
    rows += [(100 + i, "All rights reserved 1.\n" + body(60) + f"\nall rights reserved. {i}", "a") for i in range(3)]
    shared = ["\n".join([body(12)]) for _ in range(12)]
    for i in range(40):  # common lines in ever new orders: depleted
        order = rng.sample(shared, 12)
        rows.append((200 + i, "\n".join(order) + "\n" + body(5), "a"))
    same_text = body(30) + "\n" + body(30) + "\n" + body(30)
    rows += [(300 + i, same_text, "a") for i in range(50)]  # copies are one document
    rows += [(400 + i, same_text + " " + word(), "a") for i in range(50)]  # near copies share neighbours
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    judged = quality.judge(df)
    got = {r["doc_id"]: r["kept"] for r in judged.collect()}
    assert got == {r[0]: r[-1] for r in brute.quality(rows)}
    assert not any(got[200 + i] for i in range(40)) and all(got[300 + i] and got[400 + i] for i in range(50))
    kept = {r["doc_id"]: r["text"] for r in quality.clean(df).collect()}
    assert "ights" not in kept[5] and "ights" in kept[50] and len(kept[5].split("\n")) == 2


def test_quality_removes_boilerplate_of_several_lines(spark):
    rng = random.Random(4)
    body = lambda n: " ".join("".join(rng.choice("abcdefghij") for _ in range(7)) for _ in range(n))
    head, foot = [body(20) for _ in range(3)], [body(30) for _ in range(4)]
    rows = [(i, "\n".join([*head, body(15), body(15), *foot]), "a") for i in range(40)]  # unlike documents: depleted
    rows += [(100 + i, "\n".join([body(100), *foot[1:]]), "b") for i in range(40)]  # enough of their own is left
    rows += [(200 + i, "\n".join([*head, body(15), *foot]), "c") for i in range(20)]  # a host with too few documents
    copied = [body(30) for _ in range(5)]
    rows += [(300 + i, "\n".join([*copied, copied[0] + " " + body(1)]), "a") for i in range(60)]  # near copies
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r["doc_id"]: (r["kept"], r["hot"]) for r in quality.judge(df).collect()}
    assert all(got[i][0] is False and sorted(got[i][1]) == [0, 1, 2, 5, 6, 7, 8] for i in range(40))
    assert all(got[100 + i][0] and sorted(got[100 + i][1]) == [1, 2, 3] for i in range(40))
    assert all(got[200 + i] == (True, []) for i in range(20)) and all(got[300 + i] == (True, []) for i in range(60))


def test_quality_edge_rows(spark, odd, empty):
    got = [tuple(r) for r in quality.quality_digest(quality.judge(odd)).collect()]
    same(got, brute.quality([(r[0], r[1], r[3]) for r in odd_docs()]))
    assert quality.quality_digest(quality.judge(empty)).count() == 0
    assert quality.clean(odd).dtypes == odd.dtypes


def test_quality_has_no_python(spark):
    plan = quality.judge(spark.read.parquet(f"{SF}/documents.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


# --- mixing


def check_mix(rows, most=3):
    by = {}
    for r in rows:
        by.setdefault(r["source"], []).append(r)
    for source, own in by.items():
        size = sum(r["size"] for r in own)
        assert {r["source_size"] for r in own} == {size} and len({r["target"] for r in own}) == 1
        assert all(0 <= r["taken"] <= most * r["size"] for r in own)
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= max(2, size / 500), source


def test_mix_meets_its_targets_and_repeats_itself(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = mixing.mix_documents(docs).collect()
    check_mix(rows)
    again = mixing.mix_documents(docs.repartition(5)).collect()
    same([tuple(r) for r in rows], [tuple(r) for r in again])
    names = sorted({r["source"] for r in rows})
    sizes = [next(r["source_size"] for r in rows if r["source"] == n) for n in names]
    want = mixing.targets(sizes, [(5, 2, 1)[i % 3] for i in range(len(names))], sum(sizes), 3)
    got = [next(r["target"] for r in rows if r["source"] == n) for n in names]
    assert np.allclose(got, want) and np.isclose(sum(got), sum(sizes))


def test_targets_stop_at_the_limit_and_share_the_rest():
    assert mixing.targets([10, 100, 100], [5, 2, 1], 210, 3) == [30, 120, 60]
    assert mixing.targets([1, 1, 1000], [5, 2, 1], 1002, 3) == [3, 3, 996]
    assert mixing.targets([0, 0], [5, 2], 0, 3) == [0, 0]


def test_pieces_are_disjoint_blocks_of_their_shards(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = mixing.mix_documents(docs, block_words=64, shard_blocks=16).collect()
    check_mix(rows)
    block = {}
    for r in rows:
        for p in r["pieces"]:
            at = (p["shard"], p["place"])
            assert block.setdefault(at, r["source"]) == r["source"]
    per = {}
    for shard, place in block:
        per.setdefault(shard, set()).add(place)
    assert len(per) > 5 and all(x == set(range(len(x))) for x in per.values())
    assert max(map(len, per.values())) - min(map(len, per.values())) <= 1


def test_mix_texts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    plan = {r["doc_id"]: r for r in mixing.mix_documents(docs).collect()}
    out = mixing.mixed_texts(docs).collect()
    words = {}
    for r in out:
        assert len(brute.BLANK.findall(r["text"])) == r["n_words"]
        words[r["doc_id"]] = words.get(r["doc_id"], 0) + r["n_words"]
    assert words == {d: r["taken"] for d, r in plan.items() if r["taken"]}


def test_mix_edge_rows(spark, odd, empty):
    check_mix(mixing.mix_documents(odd).collect())
    assert mixing.mix_documents(odd).count() == odd.count()
    assert mixing.mix_documents(empty).count() == 0
    assert mixing.mixed_texts(odd).agg(F.sum("n_words")).first()[0] == mixing.mix_documents(odd).agg(F.sum("taken")).first()[0]


def test_permutation_is_one():
    for n in (1, 2, 3, 17, 1000):
        x = np.arange(n)
        assert sorted(mixing.permute(x, np.full(n, n), np.full(n, 99, np.uint64))) == list(range(n))


# --- secrets


def test_secrets_on_the_small_table(spark, sf_rows):
    got = {r["doc_id"]: tuple(r)[1:5] for r in queries.op6_secret_scan(spark, SF).collect()}
    assert got == {d: brute.secrets(t) for d, t in sf_rows("documents", "doc_id", "text")}


def test_secrets_planted(spark, rows):
    texts = [
        "PassWord = 'hunter22x' token:abc secret=token: abcdefgh api_key==zz.zz=z APIKEY: \"é\"",
        "éé€ 𝒳 AKIA" + "A1" * 8 + " xAKIAAKIA" + "Z" * 15 + " AKIA" + "9" * 15,
        "0123456789abcdef01234567 " + "f" * 23 + "g" + "a" * 50 + "A" + "0" * 24,
        "token=" + "0a" * 20 + "\nghp_" + "a" * 36 + " https://me:pw@host -----BEGIN RSA PRIVATE KEY-----",
        "TOKEN\n=abcdefgh secret  =  abcdefgh secret\" : \"abcdefgh toKEN'='abcdef ſecret=abcdefgh toKen=abcdefgh",
    ]
    data = [(i, t) for i, t in enumerate(texts + ODD)] + [(None, texts[0]), (0, texts[0])]
    df = rows.frame(data, "doc_id long, text string").withColumn("secrets", F.lit(1)).withColumn("kinds", F.lit("x"))
    found = secrets.find_secrets(df)
    got = [tuple(r)[:5] for r in secrets.secrets_digest(found).collect()]
    same(got, [(d, *brute.secrets(t)) for d, t in data])
    spans = {r["doc_id"]: r["secrets"] for r in found.where("doc_id = 3").collect()}[3]
    assert {s["kind"] for s in spans} == {"assign", "hex", "github", "login", "pem"}
    assert all(texts[3][s["start"] :].startswith(("token", "0a", "aa", "ghp", "https", "-----")) for s in spans)
    assert secrets.find_secrets(df.limit(0)).count() == 0


def test_trigram_queries():
    assert secrets.trigram_query("[0-9a-f]+") == []
    assert secrets.trigram_query("AKIA[A-Z0-9]+") == [[frozenset({"aki", "kia"})]]
    (ways,) = secrets.trigram_query(secrets.BASE[0].pattern)
    assert frozenset({"tok", "oke", "ken"}) in ways and len(ways) == 6
    for rule in secrets.MORE:
        assert secrets.trigram_query(rule.pattern), rule.kind


def test_secrets_have_no_python(spark):
    plan = secrets.find_secrets(spark.read.parquet(f"{SF}/documents.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


# --- languages


def test_language_on_held_out_documents(spark, sf_rows):
    folder = SF.replace("0.001", "0.01")
    langs = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang").collect()}
    rows = queries.op8_language_id(spark, folder).collect()
    out = [r for r in rows if r["held_out"]]
    assert len(rows) == len(langs) and {r["doc_id"] for r in out} == {d for d in langs if zlib.crc32(str(d).encode()) % 4 == 2}
    assert sum(r["lang_pred"] == langs[r["doc_id"]] for r in out) > 0.97 * len(out)
    assert all(0 <= r["score"] <= 1 for r in rows)


def slow_lengths(train, text, order):
    """Code length of a text in nats by the definition, from texts of one language."""
    def fold(t):
        x = [int(language.FOLD[b]) for b in t.encode()]
        return [b for i, b in enumerate(x) if b != 32 or i == 0 or x[i - 1] != 32]

    seen = {}
    for t in train:
        b = [32] * order + fold(t)
        for i in range(order, len(b)):
            for k in range(order + 1):
                seen.setdefault(tuple(b[i - k : i]), {}).setdefault(b[i], 0)
                seen[tuple(b[i - k : i])][b[i]] += 1
    total, b = 0.0, [32] * order + fold(text)
    for i in range(order, len(b)):
        for k in range(order, -1, -1):
            c = seen.get(tuple(b[i - k : i]))
            if c:
                n, d = sum(c.values()), len(c)
                if b[i] in c:
                    total -= np.log(c[b[i]] / (n + d))
                    break
                total -= np.log(d / (n + d))
        else:
            total += np.log(256)
    return total


@pytest.mark.parametrize("order", [1, 3, 4])
def test_code_lengths_are_exact(spark, order):
    learn = {"aa": ["the cat sat", "The  hat! 12 on", "a"], "bb": ["der hut ist", "ein Häuschen", ""]}
    df = spark.createDataFrame([(t, lang) for lang, ts in learn.items() for t in ts], "text string, lang string")
    model = language.train(df, order)
    texts = ["the hut", "Zebra 99 é", "", "der der der " * 50, "€"]
    raw = np.frombuffer("".join(texts).encode(), np.uint8)
    ends = np.cumsum([0] + [len(t.encode()) for t in texts])
    got = model.score(*language.grams(raw, ends, 0, len(texts), order))
    want = [[slow_lengths(learn[x], t, order) for x in ("aa", "bb")] for t in texts]
    assert np.allclose(got, want, rtol=1e-5)


@pytest.mark.parametrize("order", [2, 3, 4])
def test_a_model_in_parts_keeps_its_order(spark, sf_rows, order):
    df = spark.createDataFrame([(d, t[:400], lang) for d, t, lang in sf_rows("documents", "doc_id", "text", "lang")], "doc_id long, text string, lang string")
    learn = df.where("doc_id % 3 > 0")
    whole, parts = language.train(learn, order), language.train(learn, order, max_rows=3000)
    assert parts.order == order and len(parts.parts) > 2 and all(len(p.value["keys"][-1]) <= 3000 for p in parts.parts)
    texts = [t[:400] for (t,) in sf_rows("documents", "text")] + ["", "Zebra 99 é € 本", "the der la"]
    raw = np.frombuffer("".join(texts).encode(), np.uint8)
    ends = np.cumsum([0] + [len(t.encode()) for t in texts])
    grams = language.grams(raw, ends, 0, len(texts), order)
    assert np.allclose(parts.score(*grams), whole.score(*grams), rtol=1e-12)
    got, want = ({r["doc_id"]: r for r in language.predict(df, m).collect()} for m in (parts, whole))
    assert all(got[d]["lang_pred"] == r["lang_pred"] and np.isclose(got[d]["score"], r["score"]) for d, r in want.items())


def test_language_edge_rows(spark, odd, empty):
    model = language.train(spark.createDataFrame([("the cat", "en"), ("le chat", "fr"), (None, "de"), ("x", None)], "text string, lang string"))
    got = {(r["doc_id"], r["text"]): (r["lang_pred"], r["score"]) for r in language.predict(odd, model).collect()}
    assert got[0, None] == got[1, ""] == got[2, " \n\t "] == ("und", 0.0) and got[4, "a"][0] in ("en", "fr")
    assert {v[0] for v in got.values()} <= {"en", "fr", "und"}
    assert language.predict(empty, model).count() == 0
    assert language.train(empty) is None
    assert {r["lang_pred"] for r in language.predict(odd, None).collect()} == {"und"}


# --- chats


def test_chats_on_the_small_table(spark, sf_rows):
    said = r"\### Assistant: </turn> ok"
    rows = sf_rows("conversations", "conv_id", "turn", "role", "text") + [(-7, 0, "user", said), (-7, 1, "assistant", said)]
    got = {r["conv_id"]: tuple(r)[1:5] for r in queries.op9_chat_format(spark, SF).collect()}
    assert got == brute.chats(rows)


def test_chats_edge_rows(spark, rows):
    data = [
        (1, 0, "user", r"<turn:x>\b\l\g</turn>" + "\n"), (1, 1, "user", "<next/>"), (1, 2, "assistant", "a\\"), (1, 3, "assistant", "b<"),
        (1, 4, "assistant", None), (1, 4, "assistant", None), (1, None, "system", "€𝒳 first"), (2, 0, None, ""), (2, 0, "</turn>\n>", "t"),
        (None, 0, "assistant", "lone"), (None, 0, "assistant", "lone"), (3, 0, "assistant", ""),
    ]
    df = rows.frame(data, "conv_id long, turn long, role string, text string").withColumn("turns", F.lit(1)).withColumn("starts", F.lit(2))
    made = chat.format_chats(df)
    got = {r["conv_id"]: tuple(r)[1:5] for r in chat.chat_digest(made).collect()}
    assert got == brute.chats(data)
    one = made.where("conv_id = 1").first()
    assert one["formatted"].count("<turn:assistant>") == 1 and one["formatted"].count("<next/>") == 4
    assert chat.format_chats(df.limit(0)).count() == 0


# --- benchmark passages


def test_contamination_on_the_small_table(spark, sf_rows):
    got = [tuple(r) for r in queries.op10_decontaminate(spark, SF).collect()]
    same(got, brute.contamination(sf_rows("documents", "doc_id", "text"), sf_rows("benchmark", "item_id", "text")))


def test_contamination_edge_rows(spark, rows):
    passage = " ".join(f"w{i}" for i in range(20))
    items = [(1, passage), (2, "Short, ITEM"), (3, None), (4, "..."), (5, "w1 w2"), (1, "short item"), (None, "nul é")]
    docs = [
        (1, "x " * 50 + passage.upper().replace(" ", " -- ") + " y" * 30), (2, "short; item short ITEM"), (3, "x " * 500 + "nul É nul é"),
        (4, " ".join(f"w{i}" for i in range(12))), (5, passage[:-2] + " " + passage), *enumerate(ODD, 10), (None, "short item"), (1, "short item"),
    ]
    df = rows.frame(docs, "doc_id long, text string").withColumn("found", F.lit(1)).withColumn("items", F.lit("x"))
    bench = rows.frame(items, "item_id long, text string")
    want = brute.contamination(docs, [("" if i is None else i, t) for i, t in items])
    marked = decontaminate.mark_contaminated(df, bench)
    same([tuple(r) for r in decontaminate.contamination_digest(marked).collect()], want)
    parts = decontaminate.mark_contaminated(df, bench, chunk_chars=10)  # several automata
    same([tuple(r) for r in decontaminate.contamination_digest(parts).collect()], want)
    for r in marked.where("doc_id = 1 and n_hit > 2").collect():
        (s,) = r["spans"]
        assert r["text"][s["start"] : s["end"]] == passage.upper().replace(" ", " -- ")
    assert decontaminate.mark_contaminated(df.limit(0), bench).count() == 0
    assert not decontaminate.mark_contaminated(df, bench.limit(0)).where("contaminated").count()
    with pytest.raises(ValueError):
        decontaminate.mark_contaminated(df, bench, max_chars=5)
    assert set(decontaminate.decontaminate(df, bench).columns) == set(df.columns)


def test_sketches_are_made_of_texts_that_need_one(spark):
    """All texts with common lines pass the bitmaps, of 20,000 others few do."""
    docs = spark.range(21_000).select(F.col("id").alias("doc_id"), F.md5(F.col("id").cast("string")).alias("fp"), F.lit("=h").alias("host"))
    found = docs.where("doc_id % 21 = 0")
    got = quality.among(docs, found.select("host", "fp"))
    assert got.columns == docs.columns
    assert got.where("doc_id % 21 = 0").count() == 1000
    assert got.count() < 1000 + 20_000 / 8
    assert quality.among(docs, found.where("false")).count() == 0
