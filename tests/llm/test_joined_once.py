"""The complete search of buckets joins members with their signatures once."""

from waymark.llm import minhash


def test_members_meet_their_signatures_once(spark, monkeypatch):
    held = []

    def frozen(df, rows=None, f=minhash.frozen):
        held.append(set(df.columns))
        return f(df, rows)

    monkeypatch.setattr(minhash, "frozen", frozen)
    docs = spark.createDataFrame([(i, f"a b c d e f g h {i} x y z") for i in range(4)], "doc_id long, text string")
    assert len(minhash.near_duplicates(docs, 3, 95).collect()) == 4
    assert sum({"band_key", "rep", "comp", "signature"} <= columns for columns in held) == 1
