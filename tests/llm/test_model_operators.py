import random

from bronzegate.llm import decontaminate, kn_quality


def test_templates_and_slots(spark):
    rng = random.Random(8)
    vocab = [f"v{chr(97 + i)}{chr(97 + j)}" for i in range(26) for j in range(26)]
    fill = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    item = "a farmer named Anna has 12 apples and gives Anna 12 pears each day while walking 30 km to the old market"
    items = [(1, item), (2, fill(30)), (3, None), (4, "short one here"), (5, "seven plain words stand in this item")]
    docs = [(10, fill(50) + ". " + item + ". " + fill(50)), (11, item.replace("Anna", "Bela").replace("12", "9")),
            (12, item.replace("12", "9", 1)), (13, fill(200)), (14, None), (15, ""), (16, fill(20) + " " + items[1][1].upper().lower() + " " + fill(3)),
            (17, "so seven plain words, stand in THIS item! " + fill(9)), (10, "other text"), (None, item)]
    docs = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as hash", "2 as item_id")
    items = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["exact"] for r in decontaminate.digest(docs, items).collect()}
    assert got[10, 1] is True and got[11, 1] is False and got[16, 2] is True
    assert set(got) <= {(10, 1), (11, 1), (12, 1), (16, 2), (17, 5)}
    known, decontaminate.KNOWN = decontaminate.KNOWN, 0  # the shuffle join gives the same
    try:
        assert {(r["doc_id"], r["item_id"]): r["exact"] for r in decontaminate.digest(docs, items).collect()} == got
    finally:
        decontaminate.KNOWN = known
    assert decontaminate.digest(docs.limit(0), items).count() == decontaminate.digest(docs, items.limit(0)).count() == 0


def test_letter_case_quotes_and_short_items(spark):
    rng = random.Random(9)
    fill = lambda n: " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "kappa", "sigma"]) + rng.choice("xyz") for _ in range(n))
    item = "The old café in Straße nine sells fresh Brötchen to Anna and twelve élèves every day before 8 hours of school in Évreux"
    items = [(1, item), (2, "four words it has"), (3, "Anna Berta 12 kg 7 cm Carla 9 lbs 3 ft Dora 4 mm Emil 5 ml"), (4, "a train leaves town at 9 hours and reaches the coast after 12 hours of slow travel"),
             (5, "a buyer pays 3 for every red apple and green pear on market day while her brother later sells 4 loaves of dark bread before the shop shuts tonight")]
    docs = [(10, fill(30) + " " + item.upper() + " " + fill(30)), (11, fill(30) + " " + item.lower() + " " + fill(9)),
            (12, fill(30) + " “" + item + "” " + fill(9)), (13, fill(9) + ' he said: "' + item.title() + '"'),
            (20, fill(9) + " FOUR Words, «it has» " + fill(9)), (21, fill(9) + " four words it had " + fill(9)),
            (30, fill(9) + " " + items[2][1].upper() + " " + fill(9)), (31, fill(9) + " Bela Cora 13 kg 8 cm Dina 4 lbs 5 ft Elsa 6 mm Fritz 2 ml"),
            (40, "SO " + items[3][1].upper().replace("12", "7").replace("9", "5") + " " + fill(9)),
            (50, items[4][1].replace("3", "7").replace("4", "7").replace("while", "until")), (60, fill(200))]
    items, docs = spark.createDataFrame(items, "item_id long, text string"), spark.createDataFrame(docs, "doc_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["exact"] for r in decontaminate.digest(docs, items).collect()}
    assert got == {(10, 1): True, (11, 1): True, (12, 1): True, (13, 1): True, (20, 2): True, (30, 3): True, (40, 4): False, (50, 5): False}


def test_items_held_whole_are_found(spark):
    import re

    sf = "/root/testdata/sf0.01"
    docs, items = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "benchmark"))
    plain = lambda t: f" {' '.join(re.findall(r'[^\W_]+', (t or '').casefold()))} "
    whole = [(r["item_id"], plain(r["text"])) for r in items.collect()]
    want = {(d["doc_id"], i) for d in docs.select("doc_id", "text").collect() for body in [plain(d["text"])] for i, t in whole if t.strip() and t in body}
    assert want <= {(r["doc_id"], r["item_id"]) for r in decontaminate.digest(docs, items).collect()}


def test_quality_rejects_junk(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    got = kn_quality.digest(docs, labels).join(labels, "doc_id").groupBy("quality").agg({"kept": "count"})
    rows = kn_quality.digest(docs, labels).join(labels, "doc_id").selectExpr("quality", "cast(kept as int) k").groupBy("quality").avg("k").collect()
    share = {r[0]: r[1] for r in rows}
    assert share[1] > 0.97 and share[0] < 0.15 and got.count() == 2


def test_quality_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, "en"), (2, "", None), (3, "plain words", "en"), (None, "no id", "xx"), (3, "plain words", "en")],
                                 "doc_id long, text string, lang string").selectExpr("*", "1 as gram", "2 as row")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    kept = {r["doc_id"]: r["kept"] for r in kn_quality.digest(docs, none).collect()}
    assert kept == {1: False, 2: False, 3: True, None: True}
    assert kn_quality.digest(docs.limit(0), none).count() == 0


def test_quality_keeps_clean_languages_at_every_number_of_labels(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    trusted = labels.where("quality = 1 and toxic = 0").join(docs.select("doc_id", "lang"), "doc_id")
    clean = labels.where("quality = 1").select("doc_id")
    german = sorted(r["doc_id"] for r in trusted.where("lang = 'de'").collect())
    french = sorted(r["doc_id"] for r in trusted.where("lang = 'fr'").collect())
    spanish = sorted(r["doc_id"] for r in trusted.where("lang = 'es'").collect())
    drop = german + french[10:] + spanish[1:]  # none, ten and one label
    some = labels.where(~labels["doc_id"].isin(drop))
    rows = kn_quality.digest(docs, some).join(labels.select("doc_id", "quality"), "doc_id").collect()
    assert all(r["threshold"] is None for r in rows if r["lang"] == "de")
    for lang in ("de", "fr", "es"):
        kept = [r["kept"] for r in rows if r["lang"] == lang and r["quality"] == 1]
        assert len(kept) >= 30 and all(kept), lang
    assert not any(r["kept"] for r in rows if r["lang"] in ("en", "fr") and r["quality"] == 0)
    # Null is a language like any other, and sixty labels judge by their own quantile too.
    unnamed = docs.withColumn("lang", docs["lang"].substr(9, 1)).selectExpr("doc_id", "text", "nullif(lang, '') as lang")
    few = [r["doc_id"] for r in trusted.where("lang = 'en'").orderBy("doc_id").limit(60).collect()]
    rows = kn_quality.digest(unnamed, labels.where(labels["doc_id"].isin(few + german + french + spanish))).join(clean, "doc_id").collect()
    assert sum(r["kept"] for r in rows) >= 0.97 * len(rows) and all(r["threshold"] is not None for r in rows)
