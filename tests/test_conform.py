import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tallyloom.functions.predicates import live
from tallyloom.functions.text import text_before
from tallyloom.operators.conform import conform_parties, union_tagged
from tallyloom.operators.dedup import latest_per_key
from tallyloom.operators.lookup import code_lookup

from conftest import rows


def test_code_lookup_language_and_type(spark):
    codes = spark.createDataFrame([
        ("DOC", "cc", "ES", "CEDULA"), ("DOC", "cc", "EN", "ID CARD"),       # second language
        ("CIVIL", "cc", "ES", "CASADO CON CAPITULACIONES"),                  # same code, other type
        ("DOC", "ce", "ES", "EXTRANJERIA")], "type string, code string, lang string, meaning string")
    people = spark.createDataFrame([(1, "CC"), (2, "CE"), (3, "TI"), (4, None)], "id long, doc string")
    out = code_lookup(people, codes, "DOC", "ES", F.lower("doc"), "doc_name")
    assert rows(out, "id", "doc_name") == [(1, "CEDULA"), (2, "EXTRANJERIA"), (3, None), (4, None)]
    assert out.count() == people.count()  # the lookup never multiplies rows


def test_parties_normalised_tax_id(spark):
    customers = spark.createDataFrame([(1, "ACME SAS", "123-4"), (2, None, None)], "id long, name string, tax string")
    suppliers = spark.createDataFrame([(7, "ACME S.A.S.", "123"), (8, "BETA", "555-1")],
                                      "id long, name string, tax string")
    parties = union_tagged({"CLIENTE": customers, "PROVEEDOR": suppliers}, ["id", "name", "tax"])
    out = conform_parties(parties, "name", text_before("tax", "-"))
    got = rows(out, "origin", "id", "norm_id", "best_name", "n_names")
    # "123-4" and "123" are one party with two names (the greatest wins); a NULL id gets no label
    assert got == [("CLIENTE", 1, "123", "ACME SAS", 2), ("CLIENTE", 2, None, None, None),
                   ("PROVEEDOR", 7, "123", "ACME SAS", 2), ("PROVEEDOR", 8, "555", "BETA", 1)]


def test_current_price_per_item(spark):
    t = dt.datetime
    prices = spark.createDataFrame([
        (1, 10, Decimal("100.00"), t(2024, 1, 1), None), (1, 11, Decimal("120.00"), t(2024, 3, 1), None),
        (1, 12, Decimal("130.00"), t(2024, 3, 1), None),       # tie on updated: larger opportunity wins
        (2, 20, Decimal("50.00"), t(2024, 5, 1), "1"),         # deleted: ignored
        (2, 21, Decimal("45.00"), t(2024, 4, 1), None),
    ], "item long, opportunity long, price decimal(18,2), updated timestamp, deleted string")
    items = spark.createDataFrame([(1,), (2,), (3,)], "item long")   # item 3 never sold
    current = latest_per_key(prices.filter(live()), ["item"], ["updated", "opportunity"], cols=["price"])
    got = rows(items.join(current, "item", "left"), "item", "price")
    assert got == [(1, Decimal("130.00")), (2, Decimal("45.00")), (3, None)]


def test_fallback_chain_order_and_source(spark):
    from tallyloom.operators.lookup import fallback_chain

    lines = spark.createDataFrame([(1, "s1", "o1"), (2, "s9", "o2"), (3, "s9", "o9")], "id long, s string, o string")
    payables = spark.createDataFrame([("s1", "SUP ONE"), ("s1", "SUP ONE")], "k string, name string")  # duplicate key
    receivables = spark.createDataFrame([("o1", "CUST ONE"), ("o2", "CUST TWO")], "k string, name string")
    out = fallback_chain(lines, [("PAYABLES", payables, "s", "k", "name"),
                                 ("RECEIVABLES", receivables, "o", "k", "name")],
                         "party", default="S/N", source_col="src")
    assert rows(out, "id", "party", "src") == [(1, "SUP ONE", "PAYABLES"), (2, "CUST TWO", "RECEIVABLES"),
                                               (3, "S/N", "NONE")]


def test_master_join_one_row_per_key(spark):
    from tallyloom.operators.lookup import master_join

    t = dt.datetime
    a = spark.createDataFrame([(1, "x", t(2024, 1, 1)), (1, "y", t(2024, 2, 1)), (2, "z", t(2024, 1, 1))],
                              "opp long, step string, ts timestamp")
    b = spark.createDataFrame([(2, "deed"), (3, "notary")], "opportunity long, doc string")
    out = master_join({"flow": (a, "opp"), "docs": (b, "opportunity")}, "opp", order={"flow": ["ts"]})
    got = rows(out, "opp", "flow_step", "docs_doc")
    assert got == [(1, "y", None), (2, "z", "deed"), (3, None, "notary")]


def test_indexed_keyword_match_equals_the_plain_one(spark):
    import random

    from tallyloom.operators.conform import best_keyword_match, indexed_keyword_match

    r = random.Random(3)
    word = lambda n: "".join(r.choice("abAB_é") for _ in range(n))
    texts = [(k, word(r.randrange(25)), r.choice(["p", "q", None])) for k in range(300)] + [(900, None, "p"), (901, "", "p"), (902, "x", "z")]
    kw = [("p", f"m{k}", [word(r.randrange(1, 7)) for _ in range(3)]) for k in range(60)] + [("q", "q1", ["", "ab", None]), ("q", "q0", ["AB"])]
    df = spark.createDataFrame(texts, "id int, t string, pre string")
    words = spark.createDataFrame(kw, "prefix string, module string, words array<string>")
    args = ("id", "t", "pre")
    want = rows(best_keyword_match(df, words, *args), "id", "module", "keyword")
    assert rows(indexed_keyword_match(df, words, *args), "id", "module", "keyword") == want
    assert len({w[2] for w in want}) > 20
    none = words.filter("false")
    assert rows(indexed_keyword_match(df, none, *args), "id", "module") == sorted([(t[0], "DESCONOCIDO") for t in texts], key=repr)


def test_indexed_keyword_match_with_a_long_list(spark):
    """100,000 words under one prefix: a text meets the few words whose rarest part it holds."""
    from pyspark.sql import functions as F

    from tallyloom.operators.conform import indexed_keyword_match

    kw = spark.range(100_000).select(F.lit("p").alias("prefix"), F.concat(F.lit("m"), F.col("id")).alias("module"),
                                     F.array(F.substring(F.sha2(F.col("id").cast("string"), 256), 1, 12)).alias("words"))
    df = spark.range(2000).select("id", F.lit("p").alias("pre"), F.concat(
        F.lit("tbl_"), F.substring(F.sha2((F.col("id") * 50).cast("string"), 256), 1, 12), F.lit("_x")).alias("t"))
    got = indexed_keyword_match(df, kw, "id", "t", "pre")
    assert rows(got.select("id", "module"), "id", "module") == sorted([(k, f"m{50 * k}") for k in range(2000)], key=repr)


def test_indexed_keyword_match_broadcasts_no_text(spark, tmp_path):
    """Texts cut into parts look small to the planner: none may travel through the driver."""
    from pyspark.sql import functions as F

    from tallyloom.operators.conform import indexed_keyword_match

    spark.range(400).select("id", F.concat(F.lit("name "), F.col("id")).alias("t"), F.lit("p").alias("pre")).write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    kw = df.select(F.col("pre").alias("prefix"), F.concat(F.lit("m"), F.col("id") % 7).alias("module"), F.array("t").alias("words"))
    got = indexed_keyword_match(df, kw, "id", "t", "pre")
    assert "Broadcast" not in got._jdf.queryExecution().executedPlan().toString()
    assert rows(got, "id", "module") == sorted([(k, f"m{k % 7}") for k in range(400)], key=repr)


def test_links_by_one_key_join_the_fact_once(spark):
    from tallyloom.operators.lookup import fallback_chain

    df = spark.createDataFrame([(k, k % 3, None if k == 5 else k) for k in range(8)], "id int, a int, b int")
    look = lambda ks, tag: spark.createDataFrame([(k, f"{tag}{k}") for k in ks] + [(None, tag)], "k int, v string")
    chain = [("one", look([0], "x"), "a", "k", "v"), ("two", look([4, 5], "y"), "b", "k", "v"), ("three", look([0, 1, 1], "z"), "a", "k", "v"),
             ("four", look([2, 6], "w"), "b", "k", "v")]
    out = fallback_chain(df, chain, "got", default="-", source_col="src")
    assert rows(out, "id", "got", "src") == [(0, "x0", "one"), (1, "z1", "three"), (2, "w2", "four"), (3, "x0", "one"), (4, "y4", "two"),
                                             (5, "-", "NONE"), (6, "x0", "one"), (7, "z1", "three")]
    assert out.columns == ["id", "a", "b", "got", "src"]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftOuter") == 2 and plan.count("Join FullOuter") == 2
