"""Reading mail: raw message JSON (SC4-SC6), .eml files (SC7, SC8), dropped files (SC9, SC10, H8), CSV exports
(SC12), attachments by kind (SC13-SC19, H56), JSON in text (SC20), bodies of either type (N1, N4, H55).

Files come in through Spark's own sources, so partitions, pruning and the streaming file
log are theirs; only decoding bytes and HTML needs Python, in Arrow batches.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from email import message_from_bytes, policy
from html.parser import HTMLParser
from xml.etree import ElementTree

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_ADDRESS = "struct<emailAddress:struct<address:string,name:string>>"
#: Schema of a raw message as the mail service's API gives it.
RAW = (
    f"id string, internetMessageId string, conversationId string, inReplyTo string, subject string, `from` {_ADDRESS}, toRecipients array<{_ADDRESS}>, ccRecipients array<{_ADDRESS}>, "
    "receivedDateTime string, body struct<contentType:string,content:string>, hasAttachments boolean, isRead boolean, attachments array<struct<name:string,contentType:string,contentBytes:string>>"
)
#: Keys under which a dropped JSON file may hold a field, the first one present counts.
ALIASES = {"graph_id": ("message_id", "graph_id", "id"), "subject": ("subject",), "from_email": ("from_email", "from_address", "sender", "from"), "from_name": ("from_name",), "body": ("body", "content", "text"), "received_date_time": ("receivedDateTime", "received_date_time")}


class _Text(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out: list[str] = []
        self.hidden = 0

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style", "head"):
            self.hidden += 1
        elif tag == "li":
            self.out.append("\n- ")
        elif tag in ("br", "p", "div", "tr", "table", "h1", "h2", "h3", "h4", "ul", "ol"):
            self.out.append("\n")

    def handle_endtag(self, tag):
        if tag in ("script", "style", "head"):
            self.hidden = max(0, self.hidden - 1)
        elif tag in ("td", "th"):
            self.out.append(" | ")
        elif tag in ("p", "div", "tr", "table"):
            self.out.append("\n")

    def handle_data(self, data):
        if not self.hidden:
            self.out.append(data)


def html_text(html: str | None) -> str | None:
    """The visible text of HTML: cells separated by bars, list items with dashes."""
    if html is None:
        return None
    parser = _Text()
    parser.feed(html)
    parser.close()
    text = re.sub(r"[ \t\xa0]+", " ", "".join(parser.out))
    return re.sub(r"\n{3,}", "\n\n", "\n".join(x.strip().removesuffix(" |") for x in text.split("\n"))).strip()


@F.pandas_udf(T.StringType())
def html_to_text(html: pd.Series) -> pd.Series:
    return html.map(html_text, na_action="ignore")


def plain_body(content: Column, kind: Column) -> Column:
    """Plain text of a body, whatever its content type."""
    return F.when(F.lower(kind).contains("html"), html_to_text(content)).otherwise(content)


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """Raw messages, one JSON object a line; damaged lines give a row of nulls."""
    return spark.read.schema(RAW).json(path)


def flattened(raw: DataFrame) -> DataFrame:
    """Raw messages as flat rows; addresses lower-cased, null recipients left out."""
    address = lambda xs: F.filter(F.transform(xs, lambda x: F.lower(x["emailAddress"]["address"])), lambda x: x.isNotNull())
    return raw.select(
        F.col("id").alias("graph_id"), F.col("internetMessageId").alias("internet_message_id"), F.col("conversationId").alias("conversation_id"), F.col("inReplyTo").alias("in_reply_to"), "subject",
        F.lower("from.emailAddress.address").alias("from_email"), F.col("from.emailAddress.name").alias("from_name"), address(F.col("toRecipients")).alias("to_recipients"), address(F.col("ccRecipients")).alias("cc_recipients"),
        F.col("receivedDateTime").alias("received_date_time"), plain_body(F.col("body.content"), F.col("body.contentType")).alias("body_plain"), F.col("body.contentType").alias("raw_body_content_type"),
        F.coalesce("hasAttachments", F.lit(False)).alias("has_attachments"), F.coalesce("isRead", F.lit(False)).alias("is_read"),
    )


def from_dropped(df: DataFrame) -> DataFrame:
    """Dropped files (path, value) as messages: JSON with key aliases, else the text is the body."""
    found = {k: F.coalesce(*[F.get_json_object("value", f"$.{a}") for a in names]) for k, names in ALIASES.items()}
    is_json = F.ltrim("value").startswith("{") & F.try_parse_json("value").isNotNull()
    body = F.when(is_json, found["body"]).otherwise(F.col("value"))
    made = F.concat(F.lit("file:"), F.substring(F.sha2("value", 256), 1, 24))
    return df.select(F.coalesce(F.when(is_json, found["graph_id"]), made).alias("graph_id"), *[F.when(is_json, found[k]).alias(k) for k in ("subject", "from_email", "from_name", "received_date_time")], body.alias("body_plain"))


def read_dropped(spark: SparkSession, path: str) -> DataFrame:
    return from_dropped(spark.read.text(path, wholetext=True))


def stream_dropped(spark: SparkSession, path: str, archive: str | None = None) -> DataFrame:
    """The same as a stream; the file source's log remembers what was read, and archives it."""
    reader = spark.readStream.option("wholetext", True)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return from_dropped(reader.format("text").load(path))


def read_export(spark: SparkSession, path: str) -> DataFrame:
    """A CSV export with quoted line ends."""
    return spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)


_EML = "graph_id string, subject string, from_email string, to_recipients array<string>, received_date_time string, body_plain string, html string"


def read_eml(spark: SparkSession, path: str) -> DataFrame:
    """RFC 822 files as messages."""
    return from_eml(spark.read.format("binaryFile").load(path).select("path", "content"))


def from_eml(files: DataFrame) -> DataFrame:
    """RFC 822 bytes (path, content) as messages; bytes that are none give a row with their text
    as the body."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for name, raw in zip(b.column("path").to_pylist(), b.column("content").to_pylist()):
                m = message_from_bytes(raw, policy=policy.default)
                plain, html = m.get_body(("plain",)), m.get_body(("html",))
                rows.append({
                    "graph_id": m["message-id"] or name, "subject": m["subject"], "from_email": m["from"] and m["from"].addresses[0].addr_spec.lower() if m["from"] and m["from"].addresses else None,
                    "to_recipients": [a.addr_spec.lower() for a in m["to"].addresses] if m["to"] else [], "received_date_time": m["date"] and str(m["date"]),
                    "body_plain": plain.get_content() if plain else html_text(html.get_content()) if html else None, "html": html.get_content() if html else None,
                })
            yield pa.RecordBatch.from_pylist(rows, schema=_EML_ARROW)

    return files.select("path", "content").mapInArrow(run, _EML)


_EML_ARROW = pa.schema([(n, pa.list_(pa.string()) if n == "to_recipients" else pa.string()) for n in ("graph_id", "subject", "from_email", "to_recipients", "received_date_time", "body_plain", "html")])


def _docx(data: bytes) -> str:
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        root = ElementTree.fromstring(z.read("word/document.xml"))
    return "\n".join("".join(t.text or "" for t in p.iter() if t.tag.endswith("}t")) for p in root.iter() if p.tag.endswith("}p"))


def _xlsx(data: bytes) -> str:
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        names = z.namelist()
        shared = []
        if "xl/sharedStrings.xml" in names:
            shared = ["".join(t.text or "" for t in s.iter() if t.tag.endswith("}t")) for s in ElementTree.fromstring(z.read("xl/sharedStrings.xml"))]
        out = []
        for name in sorted(n for n in names if re.match(r"xl/worksheets/sheet\d+\.xml$", n)):
            for row in (r for r in ElementTree.fromstring(z.read(name)).iter() if r.tag.endswith("}row")):
                cells = []
                for c in row:
                    v = next((x.text or "" for x in c.iter() if x.tag.endswith("}v") or x.tag.endswith("}t")), "")
                    cells.append(shared[int(v)] if c.get("t") == "s" and v.isdigit() and int(v) < len(shared) else v)
                out.append(" | ".join(cells))
    return "\n".join(out)


def _pdf(data: bytes) -> str | None:
    try:
        from pypdf import PdfReader
    except ImportError:
        return None
    return "\n".join(p.extract_text() or "" for p in PdfReader(io.BytesIO(data)).pages)


def attachment_text(data: bytes | None, name: str | None) -> str | None:
    """The text of an attachment by its extension; null where it can't be read (a picture, a
    damaged file, a format whose library isn't there)."""
    if data is None:
        return None
    kind = (name or "").lower().rsplit(".", 1)[-1]
    try:
        if kind == "docx":
            return _docx(data)
        if kind == "xlsx":
            return _xlsx(data)
        if kind == "pdf":
            return _pdf(data)
        if kind in ("html", "htm"):
            return html_text(data.decode("utf-8", "replace"))
        if kind in ("txt", "csv", "md", "json", "log", "eml"):
            return data.decode("utf-8", "replace")
    except (KeyError, ValueError, zipfile.BadZipFile, ElementTree.ParseError):
        return None
    return None


@F.pandas_udf(T.StringType())
def decode_document(data: pd.Series, name: pd.Series) -> pd.Series:
    return pd.Series([attachment_text(d, n) for d, n in zip(data, name)], dtype="object")


def with_attachments(raw: DataFrame) -> DataFrame:
    """(graph_id, attachment_text) of raw messages: all readable attachments, in their order."""
    parts = raw.select(F.col("id").alias("graph_id"), F.posexplode("attachments").alias("at", "a"))
    parts = parts.select("graph_id", "at", decode_document(F.unbase64("a.contentBytes"), F.col("a.name")).alias("text")).where("text is not null")
    listed = F.array_sort(F.collect_list(F.struct("at", "text")))
    return parts.groupBy("graph_id").agg(F.concat_ws("\n", F.transform(listed, lambda x: x["text"])).alias("attachment_text"))


def loose_json(c: Column) -> Column:
    """The JSON object in a text, fenced or embedded, as text; null where there is none."""
    found = F.regexp_extract(c, r"(?s)(\{.*\})", 1)
    return F.when(F.try_parse_json(found).isNotNull(), found)
