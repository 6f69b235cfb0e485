import random

import pytest

import corpus_pipeline

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture
def folder(spark, tmp_path):
    rng = random.Random(7)

    def text(n):
        return " ".join("".join(rng.choices(["the", "an", "re", "on", "ti"], k=rng.randint(1, 4))) for _ in range(n))

    item, shared = text(30), text(8)
    rows = [(i, text(60)) for i in range(40)]
    rows += [(100, "\n".join([rows[0][1][:150], text(20)])), (101, rows[3][1]), (102, text(20) + " " + item + " " + text(20)),
             (103, "short one"), (104, text(40) + "\n" + shared),
             (105, text(40) + "\n  " + shared + " "), (106, None),
             (107, " ".join(rows[9][1].split()[:-1] + ["new"]))]
    docs = [(d, t, "en", "s", len(t or "")) for d, t in rows]
    spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(
        f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(40)], "doc_id bigint, quality int, toxic int").write.parquet(
        f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def test_each_stage_does_its_work(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    seen = []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/out{k}")
        docs = spark.read.parquet(f"{tmp_path}/out{k}")
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == COLUMNS, name
        seen.append({r.doc_id: r for r in docs.collect()})
    quality, lines, near, clean, coded = seen
    assert set(range(40)) <= set(quality) and not {103, 106} & set(quality)
    assert 101 not in lines and "\n" in lines[104].text and "\n" not in lines[105].text
    assert lines[105].n_chars == len(lines[105].text)
    assert 9 in near and 107 not in near
    assert 102 in near and 102 not in clean and set(range(40)) <= set(clean)
    assert set(coded) == set(clean) and all(r.n_tokens == len(r.ids) // 4 for r in coded.values())


def test_run_is_the_chain_of_stages(spark, folder):
    got = corpus_pipeline.run(spark, folder)
    assert got.count() == len({r.doc_id for r in got.select("doc_id").collect()}) >= 40
