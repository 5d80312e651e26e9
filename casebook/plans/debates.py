"""Debate payloads to sittings, sections and speeches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook.functions import text as T
from casebook.functions import urn as U
from casebook.functions.html import html_blocks
from casebook.operators.relational import islands
from casebook.plans.decisions import file_text

ADAPTER, VERSION, REVISION = "hansard", "1.1.0", 2

# The payload's fields, and how speakers are printed where they aren't marked.
PAYLOAD = "metadata struct<parlimentNO:bigint,sessionNO:bigint,volumeNO:bigint,sittingNO:bigint,sittingDate:string,partSessionStr:string,startTimeStr:string,speaker:string,dateToDisplay:string>, takesSectionVOList array<struct<startPgNo:bigint,endPgNo:bigint,title:string,subTitle:string,sectionType:string,questionNo:bigint,content:string>>, attendanceList array<struct<mpName:string,attendance:boolean,locationName:string>>"
HONORIFIC = r"(?:Mr|Mrs|Ms|Miss|Mdm|Dr|Prof|Assoc\s+Prof|Asst\s+Prof|Er|The)"
SPEAKER = rf"^\s*({HONORIFIC}\s+[^:(]{{1,80}}?)(?:\s*\(([^)]{{1,120}})\))?\s*:\s*"
ASKED = rf"^\s*(?:(\d{{1,4}})\s+)?({HONORIFIC}\s+[^:(]{{1,80}}?)(?:\s*\(([^)]{{1,120}})\))?\s+asked\s+the\s+"
QUESTION_NO = r"(?i)\bQuestion\s+No\.?\s*(\d+)\b"


def payloads(snapshots: DataFrame) -> DataFrame:
    """Sittings' payloads with their day and provenance; what isn't JSON of a sitting with a date gives no row."""
    rows = snapshots.where(~F.coalesce(F.get_json_object("params", "$.kind") == "vernacular", F.lit(False)))
    rows = rows.select(F.from_json(F.decode("body", "UTF-8"), PAYLOAD).alias("x"), F.get_json_object("params", "$.sittingDate").alias("asked"), provenance().alias("provenance"))
    day = F.try_to_timestamp(F.coalesce(F.nullif("x.metadata.sittingDate", F.lit("")), "asked"), F.lit("dd-MM-yyyy")).cast("date")
    return rows.select("x.*", "provenance", day.alias("day")).where("day is not null")


def provenance() -> Column:
    return F.struct(F.col("url").alias("source_url"), "retrieved_at", F.col("sha256").alias("snapshot_sha256"), F.lit(ADAPTER).alias("adapter"), F.lit(VERSION).alias("adapter_version"), F.lit(REVISION).alias("parser_rev"))


def sections(payloads: DataFrame) -> DataFrame:
    """One row a section (skipped ones still take an index): urn, sitting urn, day, index, heading, type, content."""
    day = F.try_to_timestamp("metadata.sittingDate", F.lit("dd-MM-yyyy")).cast("date") if "day" not in payloads.columns else F.col("day")
    rest = [c for c in ("metadata", "provenance") if c in payloads.columns]
    rows = payloads.select(day.alias("day"), *rest, F.posexplode("takesSectionVOList").alias("idx", "s"))
    title, subtitle = T.squeeze(F.coalesce("s.title", F.lit(""))), T.squeeze(F.coalesce("s.subTitle", F.lit("")))
    return rows.select(U.section(F.col("day"), F.col("idx")).alias("urn"), U.sitting(F.col("day")).alias("parent"), "day", "idx", T.heading(title, subtitle, F.col("idx")).alias("title"), title.alias("section_title"), subtitle.alias("section_subtitle"), F.col("s.sectionType").alias("section_type"), T.section_label(F.col("s.sectionType")).alias("section_type_label"), F.col("s.startPgNo").alias("start_page"), F.col("s.endPgNo").alias("end_page"), F.col("s.questionNo").alias("section_question"), F.col("s.content").alias("content"), *rest)


def speeches(secs: DataFrame) -> DataFrame:
    """One row a speech: a block with an attribution starts one, others continue it; text before the first is unattributed."""
    rows = secs.select("urn", "day", "idx", "section_type", "section_question", F.explode(html_blocks(F.coalesce("content", F.lit("")))).alias("b")).select("*", "b.pos", "b.text", "b.label").drop("b")
    marked = (F.col("label") != "") & F.col("text").startswith(F.col("label"))
    spoken, asked = F.col("text").rlike(SPEAKER), F.col("text").rlike(ASKED)
    named = lambda rx, i: F.concat(F.regexp_extract("text", rx, i), F.when(F.regexp_extract("text", rx, i + 1) != "", F.concat(F.lit(" ("), F.regexp_extract("text", rx, i + 1), F.lit(")"))).otherwise(F.lit("")))
    label = F.when(marked, F.col("label")).when(spoken, named(SPEAKER, 1)).when(asked, named(ASKED, 2))
    body = F.when(marked, F.trim(F.regexp_replace(F.expr("substring(text, length(label) + 1)"), "^[ :—-]+", ""))).when(spoken, F.trim(F.regexp_replace("text", SPEAKER, ""))).otherwise(F.col("text"))
    printed = F.when(~marked & ~spoken & asked, F.nullif(F.regexp_extract("text", ASKED, 1), F.lit("")))
    rows = rows.select("urn", "day", "idx", "section_type", "section_question", "pos", body.alias("body"), T.split_attribution(label).alias("who"), printed.alias("printed"), label.isNotNull().alias("starts"))
    rows = islands(rows, "urn", "pos", F.col("starts"))
    out = rows.groupBy("urn", "day", "idx", "section_type", "section_question", "grp").agg(
        F.min_by("who", "pos").alias("who"), F.min_by("printed", "pos").alias("printed"), F.min("pos").alias("pos"),
        F.array_join(F.filter(F.transform(F.array_sort(F.collect_list(F.struct("pos", "body"))), lambda x: x["body"]), lambda x: x != ""), "\n\n").alias("text"),
    ).where("text <> ''")
    numbered = out.withColumn("n", F.expr("row_number() over (partition by urn order by pos) - 1"))
    number = question_number(F.col("printed"), F.col("section_question"), F.col("text"))
    return numbered.select(U.speech(F.col("day"), F.col("idx"), F.col("n")).alias("urn"), F.col("urn").alias("parent"), F.col("n").alias("speech_index"), F.col("who.name").alias("speaker"), F.col("who.role").alias("speaker_role"), F.col("who.seat").alias("constituency"), number.alias("question_no"), T.is_question(number, F.col("section_type")).alias("is_question"), "text")


def sittings(payloads: DataFrame) -> DataFrame:
    day = F.to_date("metadata.sittingDate", "dd-MM-yyyy")
    return payloads.select(U.sitting(day).alias("urn"), day.alias("day"), F.size("takesSectionVOList").alias("section_count"), F.size(F.filter("attendanceList", lambda a: a["attendance"])).alias("attendance_count"), F.size("attendanceList").alias("roll_count"))


def question_number(printed: Column, field: Column, text: Column) -> Column:
    """The number printed at the question, else the section's, else one named in the first 400 characters."""
    return F.coalesce(printed, field.cast("string"), F.nullif(F.regexp_extract(F.substring(text, 1, 400), QUESTION_NO, 1), F.lit("")))


def vernacular_speaker(title: Column) -> Column:
    """Who a speech's title says that it is by."""
    return F.nullif(T.squeeze(F.regexp_extract(title, r"(?i)\bby\s+(.+?)\s*$", 1)), F.lit(""))


def _envelope(rows: DataFrame, urn: str, title: Column, text: Column, parts: Column, parent: Column, meta: Column, language: Column | None = None) -> DataFrame:
    none, cite = F.lit(None).cast("date"), F.concat(F.lit("Sing. Parl. Deb., "), F.date_format("day", "dd MMM yyyy"))
    return rows.select(F.col(urn).alias("urn"), F.lit("hansard").alias("corpus"), F.lit("PARL").alias("authority"), title.alias("title"), cite.alias("citation"), F.col("day").alias("issued"), none.alias("in_force_from"), none.alias("in_force_to"), (language if language is not None else F.lit("en")).alias("language"), text.alias("text"), parts.alias("parts"), parent.cast("string").alias("parent"), F.to_json(meta, {"ignoreNullFields": "false"}).alias("meta"), F.col("provenance"))


def documents(snapshots: DataFrame) -> DataFrame:
    """The envelope's rows: sittings, sections with speeches, speeches, vernacular speeches."""
    none, no_parts = F.lit(None).cast("string"), F.expr("cast(array() as array<string>)")
    m = "metadata."
    base = [F.col(m + "parlimentNO").alias("parliament_no"), F.col(m + "sessionNO").alias("session_no"), F.col(m + "volumeNO").alias("volume_no"), F.col(m + "sittingNO").alias("sitting_no"), T.squeeze(F.coalesce(m + "partSessionStr", F.lit(""))).alias("sitting_type")]
    about = [*base, F.col("idx").alias("section_index"), "section_title", "section_subtitle", "section_type", "section_type_label", "start_page", "end_page"]
    whole = payloads(snapshots)
    secs = sections(whole)
    said = speeches(secs)
    order = F.array_sort(F.collect_list(F.struct("speech_index", "urn")))
    spoken = said.groupBy("parent").agg(F.transform(order, lambda x: x["urn"]).alias("parts"))
    held = secs.drop("content").join(spoken.withColumnRenamed("parent", "urn"), "urn")
    in_section = said.select(F.col("urn").alias("speech"), F.col("parent").alias("urn"), "speech_index", "speaker", "speaker_role", "constituency", "is_question", "question_no", "text").join(secs.drop("content"), "urn")
    of_sitting = held.groupBy(F.col("parent").alias("urn")).agg(F.transform(F.array_sort(F.collect_list(F.struct("idx", "urn"))), lambda x: x["urn"]).alias("parts"))
    sat = whole.withColumn("urn", U.sitting(F.col("day"))).join(of_sitting, "urn")
    sitting = F.struct(*base, F.lit("sitting").alias("level"), F.size("parts").alias("section_count"), F.size(F.filter(F.coalesce("attendanceList", F.array()), lambda a: F.coalesce(a["attendance"], F.lit(False)))).alias("attendance_count"), F.greatest(F.size("attendanceList"), F.lit(0)).alias("roll_count"), T.squeeze(F.coalesce(m + "speaker", F.lit(""))).alias("presiding"), T.squeeze(F.coalesce(m + "startTimeStr", F.lit(""))).alias("start_time"))
    named = F.concat(F.lit("Parliamentary sitting, "), F.coalesce(F.nullif(m + "dateToDisplay", F.lit("")), F.col("day").cast("string")))
    speech = F.struct(*about, F.lit("speech").alias("level"), "speech_index", "speaker", "speaker_role", "constituency", "is_question", "question_no")
    out = _envelope(sat, "urn", named, F.lit(""), F.col("parts"), none, sitting)
    out = out.unionByName(_envelope(held, "urn", F.col("title"), F.lit(""), F.col("parts"), F.col("parent"), F.struct(*about, F.lit("section").alias("level"))))
    out = out.unionByName(_envelope(in_section, "speech", F.col("title"), F.col("text"), no_parts, F.col("urn"), speech))
    return out.unionByName(vernacular(snapshots))


def vernacular(snapshots: DataFrame) -> DataFrame:
    """Speeches in other languages, from their files; a file that can't be read, or without text, gives no row."""
    get = lambda k: F.get_json_object("params", f"$.{k}")
    rows = snapshots.where(get("kind") == "vernacular").withColumn("file", file_text(F.col("body"))).where("file.error is null")
    rows = rows.select(F.try_to_timestamp(get("sittingDate"), F.lit("dd-MM-yyyy")).cast("date").alias("day"), get("vernacularID").alias("id"), get("fileName").alias("file_name"), F.coalesce(F.nullif(T.clean(get("vernacularTitle")), F.lit("")), F.lit("Vernacular speech")).alias("title"), T.clean(F.col("file.text")).alias("text"), F.size(F.split("file.text", "\f")).alias("pages"), provenance().alias("provenance"))
    rows = rows.where("day is not null and id is not null and text <> ''").withColumn("urn", U.child(U.sitting(F.col("day")), F.concat(F.lit("v"), "id")))
    meta = F.struct(F.lit("vernacular").alias("level"), F.col("id").alias("vernacular_id"), "file_name", vernacular_speaker(F.col("title")).alias("speaker"), "pages")
    return _envelope(rows, "urn", F.col("title"), F.col("text"), F.expr("cast(array() as array<string>)"), U.sitting(F.col("day")), meta, T.language_by_script(F.col("text")))


def planned(since: str, until: str, spark: SparkSession) -> DataFrame:
    """key, payload of each weekday of the window."""
    days = spark.range(1).select(F.explode(F.sequence(F.lit(since).cast("date"), F.lit(until).cast("date"))).alias("day")).where(F.weekday("day") < 5)
    return days.select(F.concat(F.lit("hansard:"), F.col("day").cast("string")).alias("key"), F.to_json(F.struct(F.col("day").cast("string").alias("sitting_date"))).alias("payload"))
