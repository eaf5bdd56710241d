"""Queries that send whole tables through sources and sinks and read them back.

Each makes the outside form of a table's rows (raw messages, RFC 822 bytes, dropped files, exports,
attachments), reads it with the source, and must give the table's own values again.
"""

from __future__ import annotations

import io
import uuid
import zipfile
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestream.plans.base import query
from lodestream.plans.matching import demands, mails, stored
from lodestream.session import shared_dir
from lodestream.sources import messages, sinks
from lodestream.sources.mailbox import pages

#: Messages on a page of the recorded mailbox.
PAGE = 200


def _folder(spark, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _raw(m):
    """Rows of the mail table as raw messages of the service."""
    who = lambda a, n: F.struct(F.struct(a.alias("address"), n.alias("name")).alias("emailAddress"))
    several = lambda c: F.transform(c, lambda x: who(x, F.lit(None).cast("string")))
    return m.select(
        F.col("graph_id").alias("id"), F.col("internet_message_id").alias("internetMessageId"), F.col("conversation_id").alias("conversationId"), F.col("in_reply_to").alias("inReplyTo"), "subject",
        who(F.col("from_email"), F.col("from_name"))["emailAddress"].alias("address_"), several(F.col("to_recipients")).alias("toRecipients"), several(F.col("cc_recipients")).alias("ccRecipients"),
        F.col("received_date_time").alias("receivedDateTime"), F.struct(F.lit("text").alias("contentType"), F.col("body_plain").alias("content")).alias("body"), F.col("has_attachments").alias("hasAttachments"), F.col("is_read").alias("isRead"),
    ).withColumn("from", F.struct(F.col("address_").alias("emailAddress"))).drop("address_")


_LISTED = "len(list_filter({}, lambda x: x IS NOT NULL))::BIGINT"


@query("raw_messages", f"SELECT DISTINCT graph_id, internet_message_id, conversation_id, in_reply_to, lower(from_email) AS from_email, {_LISTED.format('to_recipients')} AS recipients, received_date_time, md5(body_plain) AS body, coalesce(is_read, false) AS is_read FROM outlook_messages WHERE graph_id IS NOT NULL")
def raw_messages(spark, folder):
    """SC3, SC4, SC5, N4, H55: mails as raw messages in JSON files and back as flat rows."""
    at = _folder(spark, "raw")
    _raw(mails(spark, folder).where("graph_id is not null")).write.json(at)
    rows = messages.flattened(messages.read_raw(spark, at))
    return rows.select("graph_id", "internet_message_id", "conversation_id", "in_reply_to", "from_email", F.size("to_recipients").cast("bigint").alias("recipients"), "received_date_time", F.md5("body_plain").alias("body"), "is_read").distinct()


@query("mailbox_pages", "SELECT DISTINCT graph_id AS id, received_date_time FROM outlook_messages WHERE graph_id IS NOT NULL AND received_date_time >= '2026-01-01'")
def mailbox_pages(spark, folder):
    """SC1, SC2, T2: a mailbox read page by page along its links, first answers failing, from a time on."""
    raw = _raw(mails(spark, folder).where("graph_id is not null")).select(F.struct("id", "receivedDateTime").alias("m"))
    per_page = raw.withColumn("page", F.spark_partition_id())

    def run(batches):
        import pyarrow as pa

        for b in batches:
            rows = [r["m"] for r in b.to_pylist()]
            book = {f"p{k}": {"value": rows[k : k + PAGE], "@odata.nextLink": f"p{k + PAGE}" if k + PAGE < len(rows) else None} for k in range(0, len(rows), PAGE)}
            failed = set()

            def get(url, book=book, failed=failed):
                for _ in range(2):
                    if url not in failed:  # the first answer to each request is an error
                        failed.add(url)
                        continue
                    return book[url]

            out = list(pages("p0", get)) if rows else []
            yield pa.RecordBatch.from_pydict({"id": pa.array([m["id"] for m in out], pa.string()), "received_date_time": pa.array([m["receivedDateTime"] for m in out], pa.string())})

    return per_page.select("m").mapInArrow(run, "id string, received_date_time string").where("received_date_time >= '2026-01-01'").distinct()


_FLAT = "regexp_replace(body_plain, '[\\x00-\\x20\\x{{85}}\\x{{2028}}\\x{{2029}}]+', '', 'g')".replace("{{", "{").replace("}}", "}")


@query("eml_messages", f"SELECT DISTINCT graph_id, lower(from_email) AS from_email, md5({_FLAT}) AS body FROM outlook_messages WHERE graph_id IS NOT NULL AND regexp_matches(from_email, '^[A-Za-z0-9._]+@[A-Za-z0-9.]+$') AND body_plain IS NOT NULL")
def eml_messages(spark, folder):
    """SC7, SC8: mails as RFC 822 bytes and back; white space is left out, as line ends may change."""
    m = mails(spark, folder).where("graph_id is not null and body_plain is not null").where(F.col("from_email").rlike("^[A-Za-z0-9._]+@[A-Za-z0-9.]+$")).select("graph_id", "from_email", "body_plain").distinct()
    head = F.concat(F.lit("Message-ID: "), F.col("graph_id"), F.lit("\r\nFrom: "), F.col("from_email"), F.lit("\r\nSubject: a demand\r\nMIME-Version: 1.0\r\nContent-Type: text/plain; charset=utf-8\r\nContent-Transfer-Encoding: base64\r\n\r\n"))
    files = m.select(F.col("graph_id").alias("path"), F.encode(F.concat(head, F.base64(F.encode("body_plain", "utf-8"))), "utf-8").alias("content"))
    rows = messages.from_eml(files)
    return rows.select("graph_id", "from_email", F.md5(F.regexp_replace("body_plain", r"[\x00-\x20\x{85}\x{2028}\x{2029}]+", "")).alias("body")).distinct()


@query("dropped_files", "SELECT DISTINCT CASE WHEN in_reply_to IS NULL THEN graph_id ELSE 'file:' || substr(sha256(body_plain), 1, 24) END AS graph_id, CASE WHEN in_reply_to IS NULL THEN subject END AS subject, md5(body_plain) AS body FROM outlook_messages WHERE graph_id IS NOT NULL AND trim(body_plain, ' ') <> '' AND NOT starts_with(ltrim(body_plain), '{')")
def dropped_files(spark, folder):
    """SC9, H8: dropped files: JSON under other key names, and plain text named by its hash."""
    m = mails(spark, folder).where("graph_id is not null and trim(body_plain) <> ''").where(~F.ltrim("body_plain").startswith("{"))
    as_json = F.to_json(F.struct(F.col("graph_id").alias("message_id"), "subject", F.col("from_email").alias("from_address"), F.col("body_plain").alias("content")))
    rows = messages.from_dropped(m.select(F.when(F.col("in_reply_to").isNull(), as_json).otherwise(F.col("body_plain")).alias("value")))
    return rows.select("graph_id", "subject", F.md5("body_plain").alias("body")).distinct()


@F.pandas_udf(T.BinaryType())
def as_docx(text: pd.Series) -> pd.Series:
    """A word processor's file with a paragraph for each line."""

    def one(t):
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as z:
            z.writestr("word/document.xml", '<w:document xmlns:w="w">' + "".join(f"<w:p><w:r><w:t>{escape(x)}</w:t></w:r></w:p>" for x in t.split("\n")) + "</w:document>")
        return out.getvalue()

    return text.map(one, na_action="ignore")


@F.pandas_udf(T.BinaryType())
def as_xlsx(text: pd.Series) -> pd.Series:
    """A sheet with one row of cells, the text cut at bars."""

    def one(t):
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as z:
            z.writestr("xl/worksheets/sheet1.xml", '<worksheet xmlns="s"><row>' + "".join(f"<c><v>{escape(x)}</v></c>" for x in t.split("|")) + "</row></worksheet>")
        return out.getvalue()

    return text.map(one, na_action="ignore")


@query("attachment_texts", "SELECT job_id AS graph_id, 'id ' || job_id || chr(10) || 'day ' || req_date || chr(10) || job_id || ' | ' || req_date || chr(10) || payload_json AS attachment_text FROM metaforge_requirements WHERE job_id IS NOT NULL AND req_date IS NOT NULL AND payload_json IS NOT NULL")
def attachment_texts(spark, folder):
    """SC6, SC13, SC14, SC15, SC17, SC19, H56: attachments in base64, decoded by kind and put together in order; a picture has no text."""
    s = stored(spark, folder).where("job_id is not null and req_date is not null and payload_json is not null")
    parts = {"a.docx": as_docx(F.concat(F.lit("id "), F.col("job_id"), F.lit("\nday "), F.col("req_date"))), "b.xlsx": as_xlsx(F.concat_ws("|", "job_id", "req_date")), "c.png": F.encode("job_id", "utf-8"), "d.txt": F.encode("payload_json", "utf-8")}
    attached = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(None).cast("string").alias("contentType"), F.base64(v).alias("contentBytes")) for n, v in parts.items()])
    return messages.with_attachments(s.select(F.col("job_id").alias("id"), attached.alias("attachments")))


_EXPORTED = ("job_id", "job_title", "location", "mandatory_skills", "source_subject")


@query("csv_exports", "SELECT DISTINCT " + ", ".join(f"nullif({c}, '') AS {c}" for c in _EXPORTED) + " FROM final_corrected_requirements WHERE job_id IS NOT NULL")
def csv_exports(spark, folder):
    """SC12, SK4, SK5, SK9: a report written as CSV and read again; a column that isn't there is empty."""
    at = _folder(spark, "export")
    sinks.report(demands(spark, folder).where("job_id is not null"), at, [*_EXPORTED, "not_there"])
    return messages.read_export(spark, at).select(*_EXPORTED).distinct()


@query("failed_deliveries", "SELECT job_id, 'refused' AS error FROM metaforge_requirements WHERE job_id LIKE '%1'")
def failed_deliveries(spark, folder):
    """SK1, SK3, SK11, T6, T12b, T12c: rows are posted from the executors; those refused are kept, to be tried again."""
    at = _folder(spark, "failed")

    def post(row):
        if (row["job_id"] or "").endswith("1"):
            raise ValueError("refused")

    rows = stored(spark, folder).select("job_id")
    sinks.deliver(post, at)(rows, 0)
    return spark.read.schema("job_id string, error string, batch_id long").parquet(at).select("job_id", "error")


@query("day_log", "SELECT strftime(make_timestamp(epoch_ms(fetched_at) * 1000), '%Y-%m-%d') AS day, count(*) AS n FROM outlook_messages WHERE fetched_at IS NOT NULL GROUP BY 1")
def day_log(spark, folder):
    """SK10, L8: rows appended to a log by day, read again with their partitions."""
    at = _folder(spark, "log")
    sinks.append_by_day(mails(spark, folder).where("fetched_at is not null").select("graph_id", F.unix_millis("fetched_at").alias("ms")), at, "ms")
    rows = spark.read.schema("graph_id string, ms long, day string").parquet(at)
    return rows.groupBy("day").agg(F.count("*").alias("n"))
