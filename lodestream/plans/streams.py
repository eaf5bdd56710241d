"""Queries that run a stream over what is there and give its result."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from lodestream.plans.base import query
from lodestream.session import shared_dir
from lodestream.sources.messages import html_to_text
from lodestream.sources.tables import table
from lodestream.streaming.ingest import seen_ingest


@query("stream_seen_ingest", "SELECT mailbox_zone, count(*) AS mails FROM (SELECT graph_id, any_value(mailbox_zone) AS mailbox_zone FROM outlook_messages WHERE graph_id IS NOT NULL GROUP BY 1) GROUP BY 1")
def stream_seen_ingest(spark, folder):
    """T1, T5, T6, T11, T12, T13, SC10: a file stream through the permanent seen-set; each mail comes out once."""
    out = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    schema = table(spark, folder, "outlook_messages").select("graph_id", "mailbox_zone").schema
    stream = spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(f"{folder}/outlook_messages.parquet*")
    seen_ingest(stream, "graph_id", f"{out}/table", f"{out}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{out}/table/data").groupBy("mailbox_zone").agg(F.count("*").alias("mails"))


@query("html_text")
def html_text(spark, folder):
    """Visible text of all documents as though they were HTML (no oracle: a parser; compared with fixtures in the tests)."""
    d = table(spark, folder, "documents").where("text is not null").select("doc_id", html_to_text("text").alias("visible"))
    return d.select("doc_id", F.length("visible").cast("bigint").alias("chars"), F.md5("visible").alias("digest"))
