"""Sources, sinks and streams on files made here."""

import base64
import io
import json
import zipfile

from pyspark.sql import functions as F

from lodestream.sources import messages, sinks
from lodestream.sources.mailbox import MailboxSource
from lodestream.streaming import ingest


def raw(k, **more):
    return {"id": f"m{k}", "internetMessageId": f"<{k}@x>", "conversationId": "c", "subject": f"S{k}", "from": {"emailAddress": {"address": "A@X.Example", "name": "A"}}, "toRecipients": [{"emailAddress": {"address": "B@X.example"}}, {"emailAddress": {}}], "receivedDateTime": f"2025-09-1{k}T00:00:00Z", "body": {"contentType": "html", "content": "<p>Hi</p><table><tr><td>a</td><td>b</td></tr></table><script>no</script><li>z"}} | more


def docx(text):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", f'<w:document xmlns:w="w"><w:p><w:r><w:t>{text}</w:t></w:r></w:p><w:p/></w:document>')
    return out.getvalue()


def xlsx():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/sharedStrings.xml", '<sst xmlns="s"><si><t>Role</t></si></sst>')
        z.writestr("xl/worksheets/sheet1.xml", '<worksheet xmlns="s"><row><c t="s"><v>0</v></c><c><v>7</v></c></row></worksheet>')
    return out.getvalue()


def test_raw_messages(spark, tmp_path):
    attached = [{"name": "a.docx", "contentBytes": base64.b64encode(docx("skill list")).decode()}, {"name": "b.xlsx", "contentBytes": base64.b64encode(xlsx()).decode()}, {"name": "c.docx", "contentBytes": "AAAA"}, {"name": "d.png", "contentBytes": None}]
    (tmp_path / "m.json").write_text("\n".join([json.dumps(raw(1, attachments=attached)), json.dumps(raw(2, body=None)), "{damaged"]))
    df = messages.read_raw(spark, str(tmp_path))
    rows = {r["graph_id"]: r for r in messages.flattened(df).collect()}
    assert rows["m1"]["from_email"] == "a@x.example" and rows["m1"]["to_recipients"] == ["b@x.example"]
    assert rows["m1"]["body_plain"] == "Hi\n\na | b\n\n- z" and rows["m2"]["body_plain"] is None and None in rows
    assert messages.with_attachments(df).collect()[0]["attachment_text"] == "skill list\n\nRole | 7"


def test_eml_and_dropped_files(spark, tmp_path):
    (tmp_path / "eml").mkdir()
    (tmp_path / "eml" / "a.eml").write_bytes(b"Message-ID: <1@x>\r\nFrom: A <A@x.example>\r\nTo: B <b@x.example>\r\nSubject: =?utf-8?q?Caf=C3=A9?=\r\nContent-Type: text/plain\r\n\r\nhello\r\n")
    r = messages.read_eml(spark, str(tmp_path / "eml")).first()
    assert (r["graph_id"], r["from_email"], r["to_recipients"], r["subject"], r["body_plain"].strip()) == ("<1@x>", "a@x.example", ["b@x.example"], "Café", "hello")
    drop = tmp_path / "drop"
    drop.mkdir()
    (drop / "a.txt").write_text("just text\nmore")
    (drop / "b.json").write_text(json.dumps({"message_id": "7", "from_address": "q@x.example", "content": "body"}))
    rows = {r["body_plain"]: r for r in messages.read_dropped(spark, str(drop)).collect()}
    assert rows["body"]["graph_id"] == "7" and rows["body"]["from_email"] == "q@x.example"
    assert rows["just text\nmore"]["graph_id"].startswith("file:")
    query = messages.stream_dropped(spark, str(drop)).writeStream.format("memory").queryName("dropped").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("dropped").count() == 2


def test_mailbox_pages(spark, tmp_path):
    second = tmp_path / "p2.json"
    second.write_text(json.dumps({"value": [raw(3)]}))
    (tmp_path / "p1.json").write_text(json.dumps({"value": [raw(1), raw(2)], "@odata.nextLink": f"file:{second}"}))
    spark.dataSource.register(MailboxSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    df = spark.read.format("mailbox").option("urls", f"file:{tmp_path}/p1.json").load()
    assert df.count() == 3
    assert sorted(r["id"] for r in df.where("receivedDateTime >= '2025-09-12'").collect()) == ["m2", "m3"]


def test_loose_json(spark):
    df = spark.createDataFrame([('```json\n{"a": 1}\n```',), ("nothing",), ("{bad",), (None,)], "t string").select(messages.loose_json(F.col("t")).alias("j"))
    assert [r["j"] for r in df.collect()] == ['{"a": 1}', None, None, None]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", 0, None), ("b", 86_400_000, "bad")], "k string, ms long, reason string")
    good, bad = sinks.split_rejected(df, "reason")
    assert good.count() == bad.count() == 1
    sinks.append_by_day(df, str(tmp_path / "log"), "ms")
    assert sorted(str(r["day"]) for r in spark.read.parquet(str(tmp_path / "log")).collect()) == ["1970-01-01", "1970-01-02"]
    sinks.report(df, str(tmp_path / "r"), ["k", "missing"])
    assert spark.read.option("header", True).csv(str(tmp_path / "r")).columns == ["k", "missing"]

    def post(row):
        if row["k"] == "b":
            raise ValueError("refused")

    sinks.deliver(post, str(tmp_path / "failed"))(df, 3)
    r = spark.read.parquet(str(tmp_path / "failed")).collect()
    assert [(x["k"], x["error"], x["batch_id"]) for x in r] == [("b", "refused", 3)]


def test_seen_ingest_and_state(spark, tmp_path):
    source = str(tmp_path / "in")
    out, point = str(tmp_path / "out"), str(tmp_path / "point")
    for k, rows in enumerate([[("a", 0), ("a", 5), (None, 1), ("b", 10)], [("a", 7), ("c", 9)]]):
        spark.createDataFrame(rows, "key string, ms long").coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema("key string, ms long").parquet(source)
        query = ingest.seen_ingest(stream, "key", out, point)
        query.awaitTermination()
        assert ingest.heartbeats(query) is not None
    assert sorted(r["key"] for r in spark.read.parquet(f"{out}/data").collect()) == ["a", "b", "c"]


def test_alert_cooldown_keeps_state_between_batches(spark, tmp_path):
    source = str(tmp_path / "in")
    results = []
    for rows in ([("a", 0), ("a", 5), ("b", 3)], [("a", 12), ("a", 30)]):
        spark.createDataFrame(rows, "key string, ms long").coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema("key string, ms long").parquet(source)
        query = ingest.cooled_alerts(stream, "key", "ms", 10).writeStream.foreachBatch(lambda df, k: results.extend(map(tuple, df.collect()))).option("checkpointLocation", str(tmp_path / "p")).trigger(availableNow=True).start()
        query.awaitTermination()
    assert sorted(results) == [("a", 0, True), ("a", 5, False), ("a", 12, False), ("a", 30, True), ("b", 3, True)]
