from pyspark.sql import functions as F

from maskloom.llm.leaks import NAME, find_leaks, templates, windows, without_leaks

ITEM = ("A farmer named Anna sold 12 apples for 3 dollars each day. After 12 days she gave 3 apples to her friend "
        "Bert and counted what was left in the basket")
OTHER = "the quick brown fox jumps over the lazy dog while eleven sleepy cats watch from a warm window"
PAD = "some text that stands before and has nothing to do with it at all "
BENCH = [(1, ITEM), (2, OTHER), (3, "too short"), (4, None), (5, ""), (2, OTHER)]


def changed(text, **pairs):
    return " ".join(pairs.get(w, w) for w in text.split(" "))


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id bigint, text string, k string, at bigint")


def test_copies_and_reparameterised_questions_are_found(spark):
    n = {"12": "40", "3": "7"}
    rows = [
        (1, PAD + ITEM + " and more"), (2, PAD + ITEM.lower().replace(".", "")), (3, PAD + changed(ITEM, **n)),
        (4, changed(ITEM, Anna="Carla", Bert="Dora", dollars="euros") + " " + PAD),
        (5, PAD + changed(ITEM, **n).replace("7 apples", "8 apples")),  # one value for two: not consistent
        (6, PAD * 4), (7, None), (8, ""), (9, " ".join(ITEM.split()[:9])), (None, OTHER), (1, PAD + ITEM + " and more"),
        (10, OTHER.upper()),
    ]
    bench = spark.createDataFrame(BENCH, "item_id bigint, text string")
    got = {(r.doc_id, r.item_id): r for r in find_leaks(frame(spark, rows), bench).collect()}
    assert set(got) == {(1, 1), (2, 1), (3, 1), (4, 1), (None, 2), (10, 2)}
    assert got[1, 1].coverage == 1.0 and got[1, 1].n_changed == 0
    assert got[3, 1].n_changed == 4 and got[4, 1].n_changed == 3
    left = without_leaks(frame(spark, rows), bench)
    assert sorted(r.doc_id for r in left.collect()) == [5, 6, 7, 8, 9] and left.columns == ["doc_id", "text", "k", "at"]


def test_empty_tables(spark):
    bench = spark.createDataFrame(BENCH, "item_id bigint, text string")
    docs = frame(spark, [(1, ITEM)])
    assert find_leaks(docs.limit(0), bench).collect() == []
    assert find_leaks(docs, bench.limit(0)).collect() == []
    assert without_leaks(docs, bench.limit(0)).count() == 1


NAMES = ("In New York the train for New Jersey waits until noon while people from New Haven read about the bridge to "
         "New London and its old keeper")
GERMAN = ("Der Bauer trug am Morgen einen Korb mit vielen Eiern in das Dorf und stellte dort den Korb vor die Tür "
          "seiner Tante, die noch schlief und von den Hühnern im Hof träumte")


def test_one_contradicted_value_spoils_only_its_windows(spark):
    bench = spark.createDataFrame([(1, NAMES), (2, GERMAN), (3, ITEM)], "item_id bigint, text string")
    rows = [(1, PAD + NAMES.replace("people", "many people")), (2, PAD + GERMAN.replace("den Korb", "den Sack")),
            (3, PAD + ITEM.replace("gave 3", "gave 9")), (4, PAD)]
    got = {(r.doc_id, r.item_id): r.coverage for r in find_leaks(frame(spark, rows), bench).collect()}
    assert set(got) == {(1, 1), (2, 2), (3, 3)} and all(0.5 <= c < 1 for c in got.values())


def test_names_that_open_sentences_short_items_and_long_runs(spark):
    tom = "Tom has 5 apples. Tom buys 3 apples. Tom eats 2 apples. How many apples does Tom have?"
    ivan = "Вчера вечером старый Иван пошёл к реке, где Иван ловил рыбу, пока сосед Ивана спал"
    chinese = "小明有五个苹果他又买了三个苹果"
    long = " ".join(f"{a}{b}" for a in "bcdfgh" for b in ["ab", "ol", "un", "ig", "er", "as", "ot", "im", "ev", "ad"])
    bench = spark.createDataFrame([(1, tom), (2, chinese), (3, long), (4, "Name three rivers"), (5, ivan), (6, "!")],
                                  "item_id bigint, text string")
    rows = [(1, tom.replace("Tom", "Ann")), (2, "前面的话" + chinese + "后面"), (3, PAD + " ".join(long.split()[20:45])),
            (4, PAD + "name three rivers. " + PAD), (5, ivan.replace("Иван ", "Пётр ")), (6, PAD + "name three big rivers"),
            (7, PAD + " ".join(long.split()[20:35]))]
    got = find_leaks(frame(spark, rows), bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(i, i) for i in (1, 2, 3, 4, 5)}


def test_numbers_alone_are_no_evidence(spark):
    numbers = " ".join(str(7 * i) for i in range(1, 31))
    bench = spark.createDataFrame([(1, numbers), (2, "Anna Bert Carla Dora Emil Fritz Gerd Hans Ida Jan Karl Lena")],
                                  "item_id bigint, text string")
    rows = [(1, " ".join(str(1000 + i) for i in range(30))), (2, "list " + numbers + " end"),
            (3, "Otto Paul Quin Rosa Sven Tina Uwe Vera Willi Xaver Yves Zora"), (4, "5 " * 40)]
    got = {(r.doc_id, r.item_id): r.n_changed for r in find_leaks(frame(spark, rows), bench).collect()}
    assert got == {(2, 1): 0}


def test_windows_are_hashed_without_copies(spark):
    texts = spark.createDataFrame([(1, ITEM), (2, OTHER + " " + OTHER), (3, "One Two. Three four Five"), (4, None)], "d int, t string")
    rows = templates(texts, "d")
    got = windows(rows, 5, 3, "d")
    assert "slice(" not in got._jdf.queryExecution().analyzed().toString()
    parts = [F.expr(f"slice({c}, {i} + 1, 5)") for c in ("plain", "typed", "opened") for i in range(0, 40, 3)]
    of = rows.select("d", F.posexplode(F.array(*parts)).alias("at", "x")).where("size(x) = 5")
    expected = of.select("d", ((F.col("at") % 14) * 3).alias("at"), F.xxhash64("x").alias("h")).distinct()
    assert rows.where(F.array_contains("opened", NAME)).count() == 2
    assert sorted(map(tuple, got.distinct().collect())) == sorted(map(tuple, expected.collect()))
