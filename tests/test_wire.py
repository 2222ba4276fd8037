from poststream.sources import wire


def test_decode_cases(spark):
    msgs = spark.createDataFrame(
        [("a", '{"id":"1","title":"t","created_utc":"x","selftext":"s","subreddit":"r",'
               '"url":"u"}'),
         ("b", "{bad"), ("c", '{"id":2,"title":null}'), ("d", None), ("e", '{"title":"no id"}')],
        "key string, value string")
    good, bad = wire.decode_json(msgs, wire.STREAM_SCHEMA)
    g = {r.id: r for r in good.collect()}
    assert set(g) == {"1", "2"}
    assert g["1"].selftext == "s" and g["2"].title is None
    reasons = {r.key: r.reason for r in bad.collect()}
    assert reasons == {"b": "malformed json", "d": "null message", "e": "missing id"}


def test_encode_roundtrip(spark):
    df = spark.createDataFrame([("1", 'quote " and\nnewline', None)],
                               "id string, title string, selftext string")
    enc = wire.encode_json(df, binary=True)
    assert enc.columns == ["key", "value"]
    good, bad = wire.decode_json(enc, wire.text_schema(["id", "title", "selftext"]))
    assert bad.count() == 0
    assert good.first().title == 'quote " and\nnewline'
