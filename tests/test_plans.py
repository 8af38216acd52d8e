"""Properties of physical plans."""

from conftest import SF_MID, SF_SMALL
from orrery.operators import text as tx
from orrery.plans import text as plans_text
from orrery.session import estimated_bytes, measured


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_sentiment_never_builds_on_tokens(spark):
    got = plan(plans_text.scored_docs(spark, SF_MID))
    token_join = [x for x in got.split("\n") if "Join" in x and "_tok" in x]
    assert len(token_join) == 1 and "BroadcastHashJoin" in token_join[0] and "BuildRight" in token_join[0] and "LeftOuter" in token_join[0]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100")
    try:  # a lexicon beyond the broadcast size: still no broadcast of tokens
        assert "Broadcast" not in plan(plans_text.scored_docs(spark, SF_MID))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_lexicon_of_unknown_size_is_written(spark):
    unknown = spark.createDataFrame(plans_text.LEXICON, "token string, valence double")
    assert estimated_bytes(unknown) > 2 ** 50 > estimated_bytes(measured(unknown))
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    one = tx.lexicon_sentiment(docs, "text", unknown, "doc_id").select("doc_id", "compound").collect()
    assert sorted(one) == sorted(plans_text.scored_docs(spark, SF_SMALL).select("doc_id", "compound").collect())


def test_modifiers_never_move_tokens(spark):
    got = plan(plans_text.rule_scored_docs(spark, SF_MID))
    joins = [x for x in got.split("\n") if "Join" in x and ("_tok" in x or "_t1" in x or "_t2" in x or "_t3" in x) and "LeftOuter" in x]
    assert len(joins) == 4 and all("BroadcastHashJoin" in x and "BuildRight" in x for x in joins)


def test_rule_sentiment_by_hand(spark):
    docs = spark.createDataFrame([(1, "good"), (2, "very good"), (3, "very x good"), (4, "very x y good"), (5, "very x y z good"), (6, "not good"),
                                  (7, "not very good"), (8, "never not good"), (9, "Very bad!"), (10, "hardly bad"), (11, "not good good"),
                                  (12, None), (13, ""), (14, "very not"), (15, "plain")], "id long, t string")
    lex = spark.createDataFrame([("good", 2.0), ("bad", -2.0), ("plain", 0.0), ("plain2", None)], "token string, valence double")
    mods = spark.createDataFrame([("very", 0.3, False), ("hardly", -0.3, False), ("not", 0.0, True), ("never", 0.0, True), ("good", 9.0, True)],
                                 "token string, boost double, negates boolean")
    norm = lambda s: s / (s * s + 15) ** 0.5
    want = {1: 2, 2: 2.3, 3: 2 + .3 * .95, 4: 2 + .3 * .9, 5: 2, 6: -.74 * 2, 7: -.74 * 2.3, 8: .74 ** 2 * 2, 9: -2.3, 10: -1.7,
            11: -.74 * 2 * 2, 12: 0, 13: 0, 14: 0, 15: 0}
    # beyond the third token a booster is not seen; 7: the booster right before, the negator two before
    got = {r.id: r.compound for r in tx.rule_sentiment(docs, "t", lex, mods, "id").collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - norm(want[k])) < 1e-9 for k in want)
