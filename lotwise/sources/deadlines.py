"""Submission deadlines from landed notice XML."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Fixed patterns of the deadline block and its fields.
BLOCK = r"(?s)<cac:TenderSubmissionDeadlinePeriod>(.*?)</cac:TenderSubmissionDeadlinePeriod>"
END_DATE = r"<cbc:EndDate>([^<]+)</cbc:EndDate>"
END_TIME = r"<cbc:EndTime>([^<]+)</cbc:EndTime>"


def earliest_deadline(xml: Column) -> Column:
    """struct(deadline, uhrzeit, lose_mit_frist) of the earliest dated block; null without one."""
    blocks = F.transform(F.regexp_extract_all(xml, F.lit(BLOCK), F.lit(1)), lambda b, i: F.struct(
        F.substring(F.regexp_extract(b, END_DATE, 1), 1, 10).alias("day"), i.alias("i"),
        F.substring(F.regexp_extract(b, END_TIME, 1), 1, 8).alias("time")))
    dated = F.filter(blocks, lambda b: b["day"] != "")
    first = F.array_min(dated)
    return F.when(F.size(dated) > 0, F.struct(
        F.try_to_date(first["day"], "yyyy-MM-dd").alias("deadline"), first["time"].alias("uhrzeit"),
        F.size(dated).alias("lose_mit_frist")))


def read_deadlines(spark: SparkSession, path: str) -> DataFrame:
    """One row per XML document; the file name is the notice id.  Documents without a
    deadline stay in the result with a reason."""
    docs = spark.read.text(path, wholetext=True).withColumn("path", F.col("_metadata.file_path"))
    name = F.regexp_extract("path", r"([^/]+?)(?:\.xml)?$", 1)
    return deadlines_of(docs.select(name.alias("notice_id"), F.col("value").alias("xml")))


def deadlines_of(docs: DataFrame) -> DataFrame:
    return docs.withColumn("x", earliest_deadline(F.col("xml"))).select(
        "notice_id", "x.*", F.when(F.col("x").isNull(), F.lit("keine Frist im XML")).alias("fehler"))


PERIOD = "struct<EndDate:string,EndTime:string>"
PROCESS = f"struct<TenderSubmissionDeadlinePeriod:{PERIOD}>"
NOTICE = f"ProcurementProjectLot array<struct<TenderingProcess:{PROCESS}>>, TenderingProcess {PROCESS}, _broken string"
OFFSET = r"(Z|[+-]\d\d:\d\d)$"


def parsed_deadlines(docs: DataFrame) -> DataFrame:
    """notice_id, xml -> the earliest deadline by a parse of the document, with the offset it was given in.

    Prefixes don't matter.  The notice's own deadline and those of its lots count.  A
    document that is no XML says so; it never stops the others.
    """
    options = {"ignoreNamespace": "true", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"}
    x = docs.withColumn("x", F.from_xml("xml", NOTICE, options))
    periods = F.concat(F.array(F.col("x.TenderingProcess.TenderSubmissionDeadlinePeriod")),
                       F.coalesce(F.transform("x.ProcurementProjectLot", lambda lot: lot["TenderingProcess"]["TenderSubmissionDeadlinePeriod"]), F.array()))
    dated = F.filter(F.transform(periods, lambda p, i: F.struct(
        F.try_to_date(F.substring(F.trim(p["EndDate"]), 1, 10), "yyyy-MM-dd").alias("day"), i.alias("i"), F.trim(p["EndTime"]).alias("time"),
        F.trim(p["EndDate"]).alias("date"))), lambda p: p["day"].isNotNull())
    rows = x.withColumn("broken", F.col("x").isNull() | F.col("x._broken").isNotNull()).withColumn("dated", dated).withColumn("first", F.array_min("dated"))
    readable = ~F.col("broken")
    offset = F.coalesce(F.nullif(F.regexp_extract("first.time", OFFSET, 1), F.lit("")), F.nullif(F.regexp_extract("first.date", OFFSET, 1), F.lit("")))
    return rows.select(
        "notice_id", F.when(readable, F.col("first.day")).alias("deadline"), F.when(readable, F.substring("first.time", 1, 8)).alias("uhrzeit"),
        F.when(readable, offset).alias("versatz"), F.when(readable & (F.size("dated") > 0), F.size("dated")).alias("lose_mit_frist"),
        F.when(F.col("broken"), F.lit("XML nicht lesbar")).when(F.size("dated") == 0, F.lit("keine Frist im XML")).alias("fehler"))
