"""Queries over the driver tables, one per operator or small group of operators.

Where the tables hold no text of the needed kind (dates, amounts, JSON lists),
Spark derives it from their rows, so the work grows with the tables.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from datetime import datetime

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from formweave.functions import chunks as C
from formweave.functions import text as X
from formweave.functions.dates import date_literals, iso_date
from formweave.functions.jsontext import parse_object, parse_objects, strip_fence
from formweave.functions.numbers import plain_number
from formweave.operators import bm25, chunking, extract, fusion, markdown, pool, status, template, vector
from formweave.operators.daterange import (
    SAMPLE_ROWS,
    conversion_ratios,
    filter_by_range,
    ranges_of_documents,
    ranges_of_lines,
    require_range,
)
from formweave.operators.positions import first_occurrence, global_position, global_rank
from formweave.queries.folders import QUERIES as FOLDER_QUERIES
from formweave.queries.folders import put, put_texts
from formweave.session import kept_path
from formweave.sinks.tables import indexed_records, write_records
from formweave.sources import docx as docx_source
from formweave.sources import files, workbook
from formweave.sources.tables import read_table

REQUEST = "请汇总 1996-03-01 至 1997/2/28 的订单"
REQUEST_EVENTS = "events from 1/5/2024 until 12.01.2024 please"
ONE_QUERY = "the of de la the license not"
BM25_THRESHOLD = 20.0
VECTOR_THRESHOLD = 0.3
MAX_LEN, SHORT_LEN = 1000, 120
ORDER_FIELDS = ["o_orderkey", "o_orderdate", "o_totalprice", "o_clerk"]


def table(spark: SparkSession, sf: str, name: str, spread: bool = False) -> DataFrame:
    return read_table(spark, f"{sf}/{name}.parquet", spread)


def joined(items: Column) -> Column:
    """Arrays as one text, so results compare without nested types."""
    return F.array_join(items, "|", "")


# --- dates -----------------------------------------------------------------

# Six ways to write a date, chosen by a number.
_WRITTEN = ["yyyy-MM-dd", "yyyy/M/d", "M-d-yyyy", "MM/dd/yyyy", "yyyy年M月d日", "d.M.yyyy"]


def _written(day: Column, number: Column) -> Column:
    out = F.date_format(day, _WRITTEN[-1])
    for i, pattern in enumerate(_WRITTEN[:-1]):
        out = F.when(number % len(_WRITTEN) == i, F.date_format(day, pattern)).otherwise(out)
    return out


def _order_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Each order as prose: two dates, an impossible day and a long number."""
    o = table(spark, sf, "orders", spread=True)
    due = F.date_add(F.col("o_orderdate").cast("date"), 30)
    text = F.concat(
        F.lit("ordered "), _written(F.col("o_orderdate"), F.col("o_orderkey")),
        F.lit(" ; due "), _written(due, F.col("o_orderkey") + 3),
        F.lit(" ; never 1997-02-30 ; number 91997-03-04 ; total "),
        F.col("o_totalprice").cast("decimal(18,2)").cast("string"), F.lit(" 元 ."),
    )
    return o.select("o_orderkey", text.alias("text"))


def date_literals_query(spark: SparkSession, sf: str) -> DataFrame:
    found = _order_texts(spark, sf).select("o_orderkey", F.inline(date_literals(F.col("text"))))
    return found.select("o_orderkey", "literal", iso_date(F.col("day")).alias("day"))


def request_ranges(spark: SparkSession, sf: str) -> DataFrame:
    r = ranges_of_documents(_order_texts(spark, sf), "o_orderkey")
    return _printed_range(r)


def doc_date_range(spark: SparkSession, sf: str) -> DataFrame:
    """Documents given line by line: one line per item, one per order."""
    items = table(spark, sf, "lineitem", spread=True).select(
        F.col("l_orderkey").alias("doc"),
        F.concat(F.lit("shipped "), _written(F.col("l_shipdate"), F.col("l_linenumber"))).alias("text"),
    )
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("doc"),
        F.concat(F.lit("ordered "), _written(F.col("o_orderdate"), F.col("o_orderkey"))).alias("text"),
    )
    return _printed_range(ranges_of_lines(items.unionAll(orders), "doc"))


def _printed_range(r: DataFrame) -> DataFrame:
    for end in ("start_date", "end_date"):
        r = r.withColumn(end, F.coalesce(iso_date(F.col(end)), F.lit("")))
    return r.withColumn("n_literals", F.col("n_literals").cast("long"))


def request_range(spark: SparkSession, text: str) -> DataFrame:
    one = spark.range(1).select(F.lit("request").alias("request"), F.lit(text).alias("text"))
    return require_range(ranges_of_documents(one, "request"))


def range_filter_orders(spark: SparkSession, sf: str) -> DataFrame:
    rows = filter_by_range(table(spark, sf, "orders"), request_range(spark, REQUEST)).table
    return rows.select("o_orderkey", iso_date(F.col("o_orderdate")).alias("o_orderdate"), "o_totalprice")


def range_filter_events(spark: SparkSession, sf: str) -> DataFrame:
    rows = filter_by_range(table(spark, sf, "events"), request_range(spark, REQUEST_EVENTS), "ts").table
    return rows.select("event_id", "event_type", "value")


def range_filter_text_dates(spark: SparkSession, sf: str) -> DataFrame:
    """A table whose dates are text, end day included whole."""
    o = table(spark, sf, "orders")
    as_text = o.select("o_orderkey", _written(F.col("o_orderdate"), F.lit(3)).alias("入库日期"))
    rows = filter_by_range(as_text, request_range(spark, REQUEST), inclusive_day=True)
    return rows.table.select("o_orderkey", iso_date(F.col("入库日期")).alias("day"))


def date_column_ratio(spark: SparkSession, sf: str) -> DataFrame:
    events = template.all_strings(table(spark, sf, "events"))
    sample = events.orderBy(F.col("event_id").cast("long")).limit(SAMPLE_ROWS)
    wide = conversion_ratios(sample)
    cells = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("ratio")) for c in wide.columns]
    return wide.select(F.inline(F.array(*cells)))


# --- templates -------------------------------------------------------------


def template_project(spark: SparkSession, sf: str) -> DataFrame:
    wanted = [" o_totalprice", "o_orderkey", "", "o_orderkey", "o_orderpriority", "o_clerk"]
    return template.all_strings(template.project(table(spark, sf, "orders"), wanted).table)


def _props(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("event_id", parse_object(F.col("props")).alias("record"))


def template_missing(spark: SparkSession, sf: str) -> DataFrame:
    fields = ["zz", "k", "unit"]
    return _props(spark, sf).select(
        "event_id",
        joined(template.present_fields(F.col("record"), fields)).alias("present"),
        joined(template.missing_fields(F.col("record"), fields)).alias("missing"),
    )


def conform_records(spark: SparkSession, sf: str) -> DataFrame:
    return template.keep_filled(template.conform(_props(spark, sf), ["k", "zz"]), ["k", "zz"])


def all_string_records(spark: SparkSession, sf: str) -> DataFrame:
    return template.all_strings(template.nan_to_null(table(spark, sf, "customer")))


def merge_records(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer").selectExpr(
        "'customer' kind", "c_custkey key", "c_name name", "c_mktsegment segment"
    )
    s = table(spark, sf, "supplier").selectExpr("'supplier' kind", "s_suppkey key", "s_name name", "s_nationkey nation")
    merged = template.union_records([c, s])
    return merged.select(
        "kind", "key", "name",
        F.coalesce("segment", F.lit("")).alias("segment"),
        F.coalesce(F.col("nation").cast("string"), F.lit("")).alias("nation"),
    )


def overlay_fill(spark: SparkSession, sf: str) -> DataFrame:
    """Customers written over a part sheet, row n over row n."""
    sheet = global_position(
        table(spark, sf, "part").selectExpr(
            "p_partkey", "p_name name", "p_brand note", "'' segment", "cast(p_size as string) size"
        ),
        ["p_partkey"],
    )
    records = global_position(
        table(spark, sf, "customer").selectExpr(
            "c_custkey", "if(c_nationkey = 7, null, c_name) name", "c_mktsegment segment"
        ),
        ["c_custkey"],
    )
    filled = template.overlay(sheet, records, ["name", "segment", None, "note", "name", "size"])
    return filled.select(
        "pos", *[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c.replace(".", "_")) for c in filled.columns if c != "pos"]
    )


def multi_template_fill(spark: SparkSession, sf: str) -> DataFrame:
    templates = {
        "prices": ["p_name", "p_retailprice"],
        "brands": ["p_brand", "p_type", "p_maker"],
        "sizes": ["p_size", "p_name"],
    }
    filled = template.fill_many(
        template.all_strings(table(spark, sf, "part")), templates, ["p_partkey"]
    )
    return filled


def empty_templates(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer")
    return c.select(
        "c_custkey", template.empty_template(F.array("c_name", "c_mktsegment")).alias("template")
    )


def numbered_records(spark: SparkSession, sf: str) -> DataFrame:
    """Records keyed by position, one JSON object per row."""
    c = template.all_strings(table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment"))
    with_key = c.withColumn("__key", F.col("c_custkey").cast("long"))
    return indexed_records(with_key, ["__key"], ["c_custkey", "c_name", "c_mktsegment"])


def first_occurrences(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").select("user_id", "event_type", "event_id", "value")
    return first_occurrence(e, ["user_id", "event_type"], ["event_id"])


def path_union(spark: SparkSession, sf: str) -> DataFrame:
    urls = table(spark, sf, "pages").select("url")
    listings = [urls.filter(F.col("url").contains(part)) for part in ("example", "https", "/en/")]
    return template.distinct_paths(listings)


# --- chunking --------------------------------------------------------------


def _docs(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents", spread=True).select("doc_id", "text")


def _parts(spark: SparkSession, sf: str, parts: Column) -> DataFrame:
    return chunking.chunks_per_document(_docs(spark, sf), parts, ["doc_id"])


def paragraph_split(spark: SparkSession, sf: str) -> DataFrame:
    return _parts(spark, sf, X.paragraphs(F.col("text"), "\n"))


def blank_line_paragraphs(spark: SparkSession, sf: str) -> DataFrame:
    """Paragraphs between blank lines, some of which hold ideographic spaces."""
    apart = F.regexp_replace("text", "\\n", "\n\u3000 \n")
    return _parts(spark, sf, X.paragraphs(apart))


def han_bigrams(spark: SparkSession, sf: str) -> DataFrame:
    """Two-character windows over Han runs beside words of spaced scripts."""
    o = table(spark, sf, "orders")
    han = F.translate(F.col("o_orderkey").cast("string"), "0123456789", "零一二三四五六七八九")
    text = F.concat(han, F.col("o_orderstatus"), F.lit(" "), han, F.lit(" 元"))
    return o.select("o_orderkey", joined(X.words_and_bigrams(text)).alias("tokens"))


def sentence_split(spark: SparkSession, sf: str) -> DataFrame:
    return _parts(spark, sf, X.sentences(F.col("text")))


def clause_split(spark: SparkSession, sf: str) -> DataFrame:
    return _parts(spark, sf, X.clauses(F.col("text")))


def hard_cut(spark: SparkSession, sf: str) -> DataFrame:
    return _parts(spark, sf, X.hard_cut(F.col("text"), 500))


def semantic_chunks(spark: SparkSession, sf: str) -> DataFrame:
    chunks = chunking.document_chunks(F.col("text"), MAX_LEN, "\n")
    return chunking.numbered_chunks(_docs(spark, sf), chunks, ["doc_id"])


def semantic_chunks_short(spark: SparkSession, sf: str) -> DataFrame:
    return _parts(spark, sf, C.semantic_chunks(F.col("text"), SHORT_LEN))


def semantic_chunks_long_first(spark: SparkSession, sf: str) -> DataFrame:
    return _parts(spark, sf, C.semantic_chunks(F.col("text"), SHORT_LEN, long_first=True))


def packed_paragraphs(spark: SparkSession, sf: str) -> DataFrame:
    return _parts(spark, sf, C.packed_paragraphs(F.col("text"), MAX_LEN // 2, "\n"))


def token_windows(spark: SparkSession, sf: str) -> DataFrame:
    return chunking.retrieval_nodes(_docs(spark, sf), "doc_id")


def slice_documents(spark: SparkSession, sf: str) -> DataFrame:
    docs = _docs(spark, sf)
    source = F.concat(F.lit("docs/"), F.col("doc_id").cast("string"), F.lit(".docx"))
    chunks = C.semantic_chunks(F.col("text"), MAX_LEN)
    sliced = chunking.slice_documents(docs, source, chunks, MAX_LEN)
    return sliced.select(
        "source", "max_slice_length", F.col("slice_count").cast("long").alias("slice_count"),
        joined(F.transform("slices", lambda s: F.concat(s["id"].cast("string"), F.lit(":"), s["text"]))).alias("slices"),
    )


# --- text ------------------------------------------------------------------


def fenced_text(spark: SparkSession, sf: str) -> DataFrame:
    return _docs(spark, sf).select(
        "doc_id", X.fence(F.col("text")).alias("markdown"), X.preview(F.col("text")).alias("preview")
    )


def clean_text(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select("page_id", X.clean(F.col("html")).alias("html"))


def path_parts(spark: SparkSession, sf: str) -> DataFrame:
    """File path parts of page addresses, taken as paths."""
    path = F.concat(F.regexp_replace(F.regexp_replace("url", "[?#].*$", ""), "/$", ""), F.lit(".Html"))
    return table(spark, sf, "pages").select(
        "page_id",
        X.file_name(path).alias("name"),
        X.stem(path).alias("stem"),
        X.suffix(path).alias("suffix"),
        X.with_suffix(path, ".md").alias("output"),
    )


def _sheet_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as ragged sheet rows, one sheet per segment; nation 3 rows are empty."""
    c = table(spark, sf, "customer")
    name, money = F.col("c_name"), F.col("c_acctbal").cast("decimal(18,2)").cast("string")
    none = F.lit(None).cast("string")
    cells = (
        F.when(F.col("c_nationkey") == 3, F.array(none, none))
        .when(F.col("c_nationkey") == 5, F.array(none, money))
        .when(F.col("c_nationkey") == 7, F.array(name))
        .otherwise(F.array(name, money, F.col("c_nationkey").cast("string")))
    )
    return c.select(F.col("c_mktsegment").alias("sheet"), F.col("c_custkey").alias("row_idx"), cells.alias("cells"))


def markdown_lines(spark: SparkSession, sf: str) -> DataFrame:
    return markdown.markdown_lines(_sheet_rows(spark, sf), ["sheet"])


def markdown_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Each order's items as a Markdown table."""
    i = table(spark, sf, "lineitem")
    cells = F.array("l_returnflag", F.col("l_linenumber").cast("string"), F.col("l_partkey").cast("string"))
    # Line numbers repeat within an order, so rows are ranked by all three keys.
    order = ["l_partkey", "l_suppkey", "l_linenumber"]
    once = i.groupBy("l_orderkey", *order).agg(F.min(cells).alias("cells"))
    ranked = global_rank(once, ["l_orderkey"], order, "row_idx")
    rows = ranked.select(F.col("l_orderkey").alias("sheet"), "row_idx", "cells")
    return markdown.markdown_tables(rows, ["sheet"])


def number_units(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer")
    plain = F.format_number(F.abs("c_acctbal"), 2)
    kind = F.col("c_custkey") % 6
    text = (
        F.when(kind == 0, F.concat(F.lit("约 "), plain, F.lit(" 万人")))
        .when(kind == 1, F.concat(F.lit("**"), plain, F.lit("** 元")))
        .when(kind == 2, F.concat(F.lit("共"), plain, F.lit("亿元")))
        .when(kind == 3, F.concat(F.lit("本日全零报告 "), plain))
        .when(kind == 4, F.concat(F.lit("-"), plain, F.lit(" 万亿")))
        .otherwise(F.lit("none"))
    )
    return c.select("c_custkey", plain_number(X.unbold(text)).alias("number"))


def mail_merge(spark: SparkSession, sf: str) -> DataFrame:
    body = F.lit("Dear {{ name }},\n{{balance}} is due. {{ name }} / {{ unknown }} / {{  segment  }}")
    c = table(spark, sf, "customer")
    values = {
        "name": F.concat(F.col("c_name"), F.lit(" $1 \\")),
        "balance": F.col("c_acctbal").cast("decimal(18,2)"),
        "segment": F.when(F.col("c_nationkey") != 3, F.col("c_mktsegment")),
    }
    return c.select("c_custkey", X.render(body, values).alias("letter"))


def mail_merge_nested(spark: SparkSession, sf: str) -> DataFrame:
    """A value that looks like a place stays as it is."""
    c = table(spark, sf, "customer")
    values = {"a": F.concat(F.lit("{{ b }}"), F.col("c_custkey").cast("string")), "b": F.col("c_name")}
    return c.select("c_custkey", X.render(F.lit("A {{ a }} B {{ b }}{{c}}"), values).alias("letter"))


def long_numbers(spark: SparkSession, sf: str) -> DataFrame:
    """Numbers of 18 digits, of 12 decimals, and large ones with a scale word."""
    key = F.lpad(F.col("o_orderkey").cast("string"), 12, "0")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        plain_number(F.concat(F.lit("号: 110101"), key, F.lit(" 件"))).alias("id_number"),
        plain_number(F.concat(F.lit("约 0."), key, F.lit("1"))).alias("decimals"),
        plain_number(F.concat(F.lit("9"), key, F.lit(".5万亿元"))).alias("scaled"),
    )


def distant_numbers(spark: SparkSession, sf: str) -> DataFrame:
    """A number far behind its field name, codes with leading zeros, and a field name inside another."""
    fields = ["合同金额", "编码", "GDP"]
    text = F.concat(
        F.lit("合同金额（含税及全部附加费用合计、不含运输）为 "), F.col("o_orderkey").cast("string"),
        F.lit(" 万元；编码: 00"), F.col("o_orderkey").cast("string"), F.lit("；人均GDP: 5；GDP: "), F.col("o_custkey").cast("string"),
    )
    rules = extract.rule_extractor(fields, {"合同金额": "number"})
    names = ["amount", "code", "gdp"]
    found = table(spark, sf, "orders").select("o_orderkey", rules(text).alias("record"))
    return found.select("o_orderkey", *[F.element_at("record", F.lit(f)).alias(n) for f, n in zip(fields, names)])


def first_filled_values(spark: SparkSession, sf: str) -> DataFrame:
    """The first of several values that is neither null nor empty."""
    part = F.col("c_custkey") % 4
    values = [F.when(part == 0, F.col("c_name")).when(part == 1, ""), F.when(part < 2, ""), F.when(part > 2, F.col("c_mktsegment"))]
    return table(spark, sf, "customer").select("c_custkey", X.first_filled(values).alias("value"))


# --- extraction ------------------------------------------------------------


def lookup_default(spark: SparkSession, sf: str) -> DataFrame:
    """Blank continents of customers placed in listed or other regions."""
    c = table(spark, sf, "customer")
    regions = F.array(*[F.lit(p) for p in [*extract.CHINESE_PROVINCES[:30], "Ohio", " 湖北省 ", "江苏"]])
    records = c.select(
        "c_custkey",
        F.element_at(regions, (F.col("c_custkey") % F.size(regions) + 1).cast("int")).alias(extract.REGION_FIELD),
        F.when(F.col("c_nationkey") == 4, F.lit("set")).otherwise(F.lit("")).alias(extract.CONTINENT_FIELD),
    )
    filled = extract.default_from_list(
        records, extract.REGION_FIELD, extract.CONTINENT_FIELD, extract.CHINESE_PROVINCES, extract.CONTINENT
    )
    return filled.select(
        "c_custkey", F.col(extract.REGION_FIELD).alias("region"), F.col(extract.CONTINENT_FIELD).alias("continent")
    )


def lookup_default_table(spark: SparkSession, sf: str) -> DataFrame:
    c, n = table(spark, sf, "customer"), table(spark, sf, "nation")
    named = c.join(n, c.c_nationkey == n.n_nationkey).select(
        "c_custkey", F.col("n_name").alias("nation"), F.when(F.col("c_custkey") % 5 == 0, F.lit("kept")).alias("area")
    )
    members = n.filter("n_regionkey = 2").select(F.col("n_name").alias("nation"))
    filled = extract.default_from_table(named, "nation", "area", members, "ASIA")
    return filled.select("c_custkey", "nation", F.coalesce("area", F.lit("")).alias("area"))


def _replies(spark: SparkSession, sf: str) -> DataFrame:
    props, kind = F.col("props"), F.col("event_id") % 7
    reply = (
        F.when(kind == 0, F.concat(F.lit("sorry, "), props))
        .when(kind == 1, F.concat(F.lit("```json\n"), props, F.lit("\n```")))
        .when(kind == 2, F.concat(F.lit("  "), props, F.lit(" \n")))
        .when(kind == 3, F.concat(props, F.lit(" done")))
        .when(kind == 4, F.concat(F.lit("["), props, F.lit("]")))
        .when(kind == 5, F.concat(F.lit("```"), props, F.lit("```")))
        .otherwise(F.concat(F.lit('{"k": "", "x": '), F.col("user_id").cast("string"), F.lit("}")))
    )
    return table(spark, sf, "events").select("event_id", reply.alias("reply"))


def reply_parse(spark: SparkSession, sf: str) -> DataFrame:
    r = _replies(spark, sf).select("event_id", parse_object(strip_fence(F.col("reply"))).alias("record"))
    accepted = r.filter(F.col("record").isNotNull())
    return template.conform(accepted, ["k", "x"])


def lenient_json(spark: SparkSession, sf: str) -> DataFrame:
    one = F.concat(F.lit('{"text": "'), F.col("event_type"), F.lit('", "id": '), F.col("event_id").cast("string"), F.lit("}"))
    two, kind = F.lit('{"note": "no text"}'), F.col("event_id") % 5
    body = (
        F.when(kind == 0, F.concat(one, F.lit(","), two, F.lit(",")))
        .when(kind == 1, F.concat(F.lit("["), two, F.lit(","), one, F.lit("]")))
        .when(kind == 2, one)
        .when(kind == 3, F.concat(one, F.lit("\n"), one))
        .otherwise(F.concat(F.lit("["), one))
    )
    e = table(spark, sf, "events").select("event_id", F.explode(parse_objects(body)).alias("o"))
    return e.filter(F.col("o")["text"].isNotNull()).select(
        "event_id", F.col("o")["text"].alias("text"), F.col("o")["id"].alias("id")
    )


def extraction_prompts(spark: SparkSession, sf: str) -> DataFrame:
    return _docs(spark, sf).select(
        "doc_id", extract.instruction(["amount", "date"], F.col("text")).alias("prompt")
    )


RECORD_FIELDS = ["kind", "金额", "日期", extract.REGION_FIELD, extract.CONTINENT_FIELD]


def _event_prose(spark: SparkSession, sf: str) -> DataFrame:
    """Events as sentences a rule can read back."""
    e = table(spark, sf, "events", spread=True)
    text = F.concat(
        F.lit("kind: "), F.col("event_type"), F.lit("; 金额约 "),
        F.format_number("value", 2), F.lit(" 万元; 日期 "), F.date_format("ts", "yyyy/M/d"),
        F.when(F.col("user_id") % 2 == 0, F.lit("; **湖北省** 上报")).otherwise(F.lit("")),
    )
    return e.select("event_id", text.alias("text"))


def rule_records(spark: SparkSession, sf: str) -> DataFrame:
    kinds = {"kind": "text", "金额": "number"}
    r = extract.extract_records(
        _event_prose(spark, sf), RECORD_FIELDS, extract.rule_extractor(RECORD_FIELDS, kinds)
    )
    return r.select(
        "event_id", "kind", F.col("金额").alias("amount"), F.col("日期").alias("day"),
        F.col(f"`{extract.REGION_FIELD}`").alias("region"), F.col(extract.CONTINENT_FIELD).alias("continent"),
    )


def rule_entities(spark: SparkSession, sf: str) -> DataFrame:
    e = pool.rule_entities(_order_texts(spark, sf), "o_orderkey")
    return e.select("o_orderkey", "field", "value", "raw", "tier")


def entity_pool(spark: SparkSession, sf: str) -> DataFrame:
    """Rule values against a second, less or more certain source, best one kept."""
    rules = pool.rule_entities(_order_texts(spark, sf), "o_orderkey").select(
        "o_orderkey", "field", "value", "confidence", "tier"
    )
    other = table(spark, sf, "orders").select(
        "o_orderkey",
        F.lit("amount").alias("field"),
        F.col("o_totalprice").cast("decimal(18,1)").cast("string").alias("value"),
        F.when(F.col("o_orderpriority") == "1-URGENT", 0.95).otherwise(0.5).alias("confidence"),
        F.lit("model").alias("tier"),
    )
    status_field = table(spark, sf, "orders").select(
        "o_orderkey", F.lit("status").alias("field"), F.col("o_orderstatus").alias("value"),
        F.lit(0.7).alias("confidence"), F.lit("model").alias("tier"),
    )
    best = pool.best_values(rules.unionByName(other).unionByName(status_field), ["o_orderkey", "field"])
    return pool.flag_review(best)


# --- retrieval -------------------------------------------------------------


def _index(spark: SparkSession, sf: str) -> bm25.TermIndex:
    return bm25.build_index(_docs(spark, sf), node="doc_id")


def _text_queries(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))


def _vectors(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").select(F.col("vec_id").alias("node_id"), "embedding", "label")


def _queries(spark: SparkSession, sf: str) -> DataFrame:
    """Benchmark texts as queries, each with the vector of the same number."""
    v = _vectors(spark, sf).select(F.col("node_id").alias("query_id"), "embedding")
    return _text_queries(spark, sf).join(v, "query_id")


def bm25_stats(spark: SparkSession, sf: str) -> DataFrame:
    return _index(spark, sf).terms.select("term", "n_nodes", F.round("idf", 6).alias("idf"))


def bm25_topk(spark: SparkSession, sf: str) -> DataFrame:
    return bm25.best_matches(_index(spark, sf), _text_queries(spark, sf), fusion.TOP_K, decimals=4)


def bm25_topk_large(spark: SparkSession, sf: str) -> DataFrame:
    """More hits per query than the usual few."""
    return bm25.best_matches(_index(spark, sf), _text_queries(spark, sf), 1500, decimals=4)


def bm25_all(spark: SparkSession, sf: str) -> DataFrame:
    scored = bm25.all_scores(_index(spark, sf), ONE_QUERY)
    return scored.select("node_id", F.round("score", 4).alias("score"))


def bm25_threshold(spark: SparkSession, sf: str) -> DataFrame:
    hits = fusion.search_above(_text_queries(spark, sf), "bm25", BM25_THRESHOLD, index=_index(spark, sf))
    return hits.withColumn("score", F.round("score", 4))


def vector_topk(spark: SparkSession, sf: str) -> DataFrame:
    return vector.nearest(_vectors(spark, sf), _queries(spark, sf), fusion.TOP_K)


def _label_queries(spark: SparkSession, sf: str) -> DataFrame:
    c = vector.centroids(_vectors(spark, sf), "label")
    return c.select(F.col("label").cast("long").alias("query_id"), "embedding")


def vector_threshold(spark: SparkSession, sf: str) -> DataFrame:
    return fusion.search_above(
        _label_queries(spark, sf), "vector", VECTOR_THRESHOLD, vectors=_vectors(spark, sf)
    )


def field_match(spark: SparkSession, sf: str) -> DataFrame:
    """Each label's centroid as a template field, the vectors as extracted fields."""
    return pool.match_fields(_label_queries(spark, sf), _vectors(spark, sf), 0.2)


def hybrid_rrf(spark: SparkSession, sf: str) -> DataFrame:
    fused = fusion.hybrid(_index(spark, sf), _vectors(spark, sf), _queries(spark, sf))
    return fusion.fused_top(fused)


def hybrid_rrf_all(spark: SparkSession, sf: str) -> DataFrame:
    """Fusion over the ranks of all scoring nodes rather than the first five."""
    fused = fusion.hybrid(_index(spark, sf), _vectors(spark, sf), _queries(spark, sf), candidates_k=None)
    return fusion.fused_top(fused)


def evidence(spark: SparkSession, sf: str) -> DataFrame:
    """BM25 hits with their metadata and the head of their text."""
    d = table(spark, sf, "documents")
    nodes = d.select(
        F.col("doc_id").alias("node_id"), "text",
        F.create_map(F.lit("lang"), "lang", F.lit("source"), "source").alias("metadata"),
    )
    hits = bm25.best_matches(_index(spark, sf), _text_queries(spark, sf), decimals=4)
    found = fusion.with_sources(hits, nodes)
    return found.select(
        "query_id", "rank", "node_id", "score",
        F.col("metadata")["lang"].alias("lang"), F.col("metadata")["source"].alias("source"),
        X.preview(F.col("text")).alias("preview"),
    )


def hit_counts(spark: SparkSession, sf: str) -> DataFrame:
    """How many hits each query has beyond the ten shown."""
    hits = bm25.matched_scores(_index(spark, sf), _text_queries(spark, sf))
    shown, rest = fusion.first_hits(hits.withColumn("score", F.round("score", 4)))
    return shown.groupBy("query_id").agg(F.count("*").alias("n_shown")).join(rest, "query_id")


def stored_index(spark: SparkSession, sf: str) -> DataFrame:
    """An index written to storage, opened again and searched."""
    path = kept_path(spark, "index")

    def nodes() -> DataFrame:
        return _docs(spark, sf).withColumnRenamed("doc_id", "node_id")

    bm25.load_or_build_index(spark, path, nodes)
    index = bm25.load_or_build_index(spark, path, nodes)
    return bm25.best_matches(index, _text_queries(spark, sf), fusion.TOP_K, decimals=4)


def evidence_hybrid(spark: SparkSession, sf: str) -> DataFrame:
    """The fused hits of both retrievers with their metadata and the head of their text."""
    d = table(spark, sf, "documents")
    nodes = d.select(F.col("doc_id").alias("node_id"), "text", F.create_map(F.lit("lang"), "lang").alias("metadata"))
    fused = fusion.hybrid(_index(spark, sf), _vectors(spark, sf), _queries(spark, sf))
    found = fusion.with_sources(fusion.fused_top(fused), nodes)
    return found.select("query_id", "rank", "node_id", "score", F.col("metadata")["lang"].alias("lang"), X.preview(F.col("text")).alias("preview"))


def vector_text_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Neighbours over ids of text; a tenth each of the vectors is missing, short, zero or holds a null."""
    nodes = _odd_vectors(spark, sf).withColumn("node_id", F.concat(F.lit("v#"), F.col("node_id").cast("string")))
    asked = nodes.filter(F.col("node_id").rlike("[05]$")).withColumnRenamed("node_id", "query_id")
    return vector.nearest(nodes, asked, fusion.TOP_K)


def vector_left_out(spark: SparkSession, sf: str) -> DataFrame:
    """How many vectors cannot be compared with the others, and why."""
    nodes = _odd_vectors(spark, sf)
    return vector.left_out(nodes, nodes.filter("node_id % 10 = 0").withColumnRenamed("node_id", "query_id"))


def _odd_vectors(spark: SparkSession, sf: str) -> DataFrame:
    kind, v = F.col("node_id") % 10, F.col("embedding")
    odd = (
        F.when(kind == 1, F.lit(None))
        .when(kind == 2, F.slice(v, 1, 32))
        .when(kind == 3, F.transform(v, lambda x: x * 0))
        .when(kind == 4, F.transform(v, lambda x, i: F.when(i > 0, x)))
        .otherwise(v)
    )
    return _vectors(spark, sf).select("node_id", odd.alias("embedding"))


# Windows small enough that the documents give many, and some sentences are too long.
WINDOW, CARRIED = 40, 8


def sentence_nodes(spark: SparkSession, sf: str) -> DataFrame:
    """Windows of whole sentences over documents, each followed by text without spaces."""
    han = F.translate(F.repeat(F.col("doc_id").cast("string"), 25), "0123456789", "零一二三。五六七八九")
    d = table(spark, sf, "documents", spread=True).select("doc_id", F.concat("text", F.lit("\n"), han).alias("text"))
    return chunking.sentence_nodes(d, "doc_id", WINDOW, CARRIED)


def letter_counts(text: Column) -> Column:
    """A vector of a text: how often it holds each of eight letters."""
    return F.array(*[(F.length(text) - F.length(F.replace(text, F.lit(c)))).cast("double") for c in "aeinorst"])


FOLDER_THRESHOLDS = {"bm25": 12.0, "vector": 0.99, "hybrid": 0.0}


def folder_search(spark: SparkSession, sf: str) -> DataFrame:
    """Documents written as files, indexed with vectors, opened again, and searched in all modes."""
    from formweave.plans.search import open_folder, search_folder

    folder, path = kept_path(spark, "texts"), kept_path(spark, "index")
    put_texts(table(spark, sf, "documents").select("doc_id", "text"), folder)
    open_folder(spark, path, folder, recursive=True, size=WINDOW, overlap=CARRIED)
    index = open_folder(spark, path, folder, letter_counts)
    found = None
    for mode, threshold in FOLDER_THRESHOLDS.items():
        hits = search_folder(_text_queries(spark, sf), index, mode, letter_counts, threshold=threshold)
        part = hits.select(F.lit(mode).alias("mode"), "query_id", "node_id", F.round("score", 4).alias("score"), "text")
        found = part if found is None else found.unionByName(part)
    place = lambda pattern: F.regexp_extract("node_id", pattern, 1).cast("long")
    return found.select("mode", "query_id", place("doc_id=([0-9]+)[-/]").alias("doc_id"), place("#([0-9]+)$").alias("chunk"), "score", "text")


def retrieval_chunks(spark: SparkSession, sf: str) -> DataFrame:
    """Fusion-ready nodes: every window of every document, searched for one query."""
    chunks = chunking.retrieval_nodes(_docs(spark, sf), "doc_id", size=64, overlap=8)
    nodes = chunks.select((F.col("doc_id") * 100000 + F.col("id")).alias("node_id"), "text")
    scored = bm25.all_scores(bm25.build_index(nodes), ONE_QUERY)
    return scored.select("node_id", F.round("score", 4).alias("score"))


# --- documents and files ---------------------------------------------------

# Each order as a workbook file: a filled sheet and one without rows.
_BOOK_HEADER = ["订单", "UpdateTime", None, "价格"]


def _order_books(spark: SparkSession, sf: str) -> DataFrame:
    """path, content: one small workbook per order."""
    from formweave.queries.office import xlsx

    def book(key: int, day: str, price: float, status: str) -> bytes:
        serial = (datetime.fromisoformat(day) - datetime(1899, 12, 30)).days
        filled = [_BOOK_HEADER, [key, ("date", serial), status, price], [], [key, ("date", serial + 400), None, 7]]
        return xlsx({"data": filled, "notes": [["empty"]]})

    @F.pandas_udf("binary")
    def books(key: pd.Series, day: pd.Series, price: pd.Series, status: pd.Series) -> pd.Series:
        return pd.Series([book(*row) for row in zip(key, day, price, status)])

    o = table(spark, sf, "orders", spread=True)
    return o.select(
        F.concat(F.lit("books/"), F.col("o_orderkey").cast("string"), F.lit(".xlsx")).alias("path"),
        books("o_orderkey", iso_date(F.col("o_orderdate")), "o_totalprice", "o_orderstatus").alias("content"),
    )


def workbook_cells(spark: SparkSession, sf: str) -> DataFrame:
    rows = workbook.decode_workbooks(_order_books(spark, sf))
    return rows.select(
        "path", "sheet", "sheet_idx", "row_idx", joined(F.col("header")).alias("header"),
        F.coalesce(joined(F.col("cells")), F.lit("none")).alias("cells"),
    )


def workbook_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Two named columns of the first sheets, as records."""
    rows = workbook.decode_workbooks(_order_books(spark, sf), sheet=0, columns=["价格", "订单"])
    record = F.col("record")
    return workbook.records(rows).select("path", "row_idx", record["订单"].alias("key"), record["价格"].alias("price"))


def workbook_markdown(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as sheets of a book for each year, one sheet empty; Markdown in bounded parts."""
    o = table(spark, sf, "orders").select(F.year("o_orderdate").cast("string").alias("path"), "o_orderkey", "o_orderstatus")
    rows = o.select(
        "path", F.concat(F.lit("s"), "o_orderstatus").alias("sheet"), F.ascii("o_orderstatus").alias("sheet_idx"),
        F.col("o_orderkey").cast("int").alias("row_idx"),
        F.array(F.col("o_orderkey").cast("string"), F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderstatus"))).alias("cells"),
    )
    none = o.select("path", F.lit("none").alias("sheet"), F.lit(1).alias("sheet_idx"), F.lit(0).alias("row_idx"), F.lit(None).cast("array<string>").alias("cells"))
    parts = markdown.workbook_parts(rows.unionByName(none.distinct()), part_rows=100)
    return parts.select("path", "sheet", "sheet_idx", "part", "markdown")


def workbook_range(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of all books within the requested range, by each sheet's own date column."""
    rows = workbook.decode_workbooks(_order_books(spark, sf), dated=True)
    kept = workbook.filter_rows(rows, request_range(spark, REQUEST))
    return kept.select("path", "sheet", "row_idx", F.coalesce(joined(F.col("cells")), F.lit("none")).alias("cells"))


def _document_files(spark: SparkSession, sf: str) -> DataFrame:
    """path, content: each document as a Word file, a line per paragraph."""
    from formweave.queries.office import docx

    def files(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for at in range(0, batch.num_rows, 64):  # few files at once, whatever the batch
                path, text, lang = (batch.column(i).slice(at, 64) for i in range(3))
                made = [docx(t.split("\n"), [[g, ""], ["", g]], g, "end") for t, g in zip(text.to_pylist(), lang.to_pylist())]
                yield pa.record_batch([path.cast(pa.string()), pa.array(made, pa.binary())], names=["path", "content"])

    # XML cannot hold control characters.
    text = F.regexp_replace("text", "[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F]", "")
    d = table(spark, sf, "documents", spread=True)
    path = F.concat(F.lit("docs/"), F.col("doc_id").cast("string"), F.lit(".docx"))
    return d.select(path.alias("path"), text.alias("text"), "lang").mapInArrow(files, "path string, content binary")


def docx_blocks(spark: SparkSession, sf: str) -> DataFrame:
    return docx_source.block_rows(docx_source.decode_docx(_document_files(spark, sf)))


def docx_slices(spark: SparkSession, sf: str) -> DataFrame:
    """Word files to nested slices, a block never sharing a slice with the next."""
    docs = docx_source.decode_docx(_document_files(spark, sf))
    chunks = F.flatten(F.transform("blocks", lambda b: C.semantic_chunks(b["text"], SHORT_LEN)))
    sliced = chunking.slice_documents(docs, F.col("path"), chunks, SHORT_LEN)
    return sliced.select(
        "source", F.col("slice_count").cast("long").alias("slice_count"),
        joined(F.transform("slices", lambda s: F.concat(s["id"].cast("string"), F.lit(":"), s["text"]))).alias("slices"),
    )


def decoded_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Documents stored in several encodings and line ends, read back as text."""
    d = _docs(spark, sf)
    latin = F.encode(F.regexp_replace("text", "[^\\x00-\\xFF]", "?"), "ISO-8859-1")
    wide = F.encode(F.regexp_replace("text", "\n", "\r\n"), "UTF-8")
    content = F.when(F.col("doc_id") % 2 == 0, wide).otherwise(latin)
    return d.select("doc_id", files.decoded(content, ("utf-8", "latin-1")).alias("text"))


def stored_records(spark: SparkSession, sf: str) -> DataFrame:
    """Records written per input and read back with nulls in place."""
    path = kept_path(spark, "records")
    c = template.all_strings(
        table(spark, sf, "customer").selectExpr(
            "c_custkey", "c_name", "if(c_nationkey = 3, null, c_acctbal) balance", "c_mktsegment source_file"
        )
    )
    write_records(c, path, by=["source_file"])
    back = spark.read.schema(c.schema).json(path)
    return back.withColumn("balance", F.coalesce("balance", F.lit("null")))


# --- status ----------------------------------------------------------------


def fill_many_in_place(spark: SparkSession, sf: str) -> DataFrame:
    """Parts written over the rows of three sheets: one longer than the parts, one shorter, one empty."""
    parts = table(spark, sf, "part").selectExpr(
        "p_partkey", "if(p_size = 7, null, p_name) name", "p_brand brand", "if(p_size = 9, '', p_type) type"
    )
    records = global_position(parts, ["p_partkey"]).drop("p_partkey")
    orders = global_position(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority"), ["o_orderkey"])
    suppliers = global_position(table(spark, sf, "supplier").select("s_suppkey", "s_name"), ["s_suppkey"])
    none = F.lit(None).cast("string")
    rows = orders.select(F.lit("orders").alias("template"), "pos", F.array("o_orderstatus", none, "o_orderpriority").alias("cells"))
    rows = rows.unionByName(
        suppliers.select(F.lit("suppliers").alias("template"), "pos", F.array("s_name", F.lit("x"), none, F.lit("last")).alias("cells"))
    )
    headers = [("orders", ["type", "name", "name"]), ("suppliers", ["absent", None, "brand"]), ("empty", ["brand"])]
    headers = spark.createDataFrame(headers, "template string, header array<string>")
    filled = template.fill_many_in_place(records, headers, rows)
    return filled.select("template", "pos", joined(F.col("cells")).alias("cells"))


def job_report(spark: SparkSession, sf: str) -> DataFrame:
    """A job over a text and a workbook for each nation; some books are broken or of another form, some texts undecodable."""
    from formweave.plans.fill import run_job
    from formweave.queries.office import xlsx

    request, data, sheet = (kept_path(spark, k) for k in ("request", "data", "sheet"))
    put(spark, request, "request.txt", REQUEST.encode())
    put(spark, sheet, "sheet.xlsx", xlsx({"s": [["kind", "UpdateTime", "nation"], ["old", None, None]]}))
    # One row a nation: the files of books are few, whatever the tables' size.
    for n in table(spark, sf, "nation").select("n_nationkey", "n_name").collect():
        days = ["1996-05-01", "1999-01-01", "1997-01-01"][: 1 + n.n_nationkey % 3]
        rows = [["UpdateTime", "nation"], *[[d, n.n_name] for d in days]] if n.n_nationkey % 5 > 1 else [["other"], [1]]
        put(spark, data, f"book{n.n_nationkey}.xlsx", b"no book" if n.n_nationkey % 5 == 0 else xlsx({"s": rows}))
        if n.n_nationkey % 10 == 3:
            put(spark, data, f"bad{n.n_nationkey}.txt", b"\xff\xff")
    c = table(spark, sf, "customer").groupBy("c_nationkey").agg(F.count("*").alias("n"), F.max("c_custkey").alias("top"))
    text = F.concat(F.lit("kind: "), F.col("n").cast("string"), F.lit("; until "), F.col("top").cast("string"))
    c.select("c_nationkey", text.alias("text")).write.partitionBy("c_nationkey").text(f"{data}/texts")
    job = run_job(spark, request, data, sheet, kinds={"kind": "text"}, recursive=True)
    name = F.coalesce(F.nullif(F.regexp_extract("path", "c_nationkey=[0-9]+", 0), F.lit("")), X.file_name(F.col("path")))
    return job.report.select(
        name.alias("file"), "kind", "status", (F.col("message") != "").alias("told"), "n_read", "n_records"
    )


def _conversions(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "lang")
    marked = status.mark_existing(docs, table(spark, sf, "labels"), ["doc_id"])
    broken = F.col("lang") == "fr"
    return marked.withColumn(
        "status", F.when((F.col("status") == status.DONE) & broken, status.FAILED).otherwise(F.col("status"))
    )


def skip_existing(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "lang")
    return status.not_existing(docs, table(spark, sf, "labels"), ["doc_id"])


def run_stats(spark: SparkSession, sf: str) -> DataFrame:
    return status.run_stats(_conversions(spark, sf))


# --- the whole job ---------------------------------------------------------


def template_fill(spark: SparkSession, sf: str) -> DataFrame:
    """A request, a table and prose, filled into one template.

    Orders in the requested range and records read from event prose are
    unioned and written over the rows of a prepared sheet.
    """
    from formweave.plans.fill import fill_template

    header = ["o_orderkey", "o_orderdate", "o_totalprice", "kind", "金额"]
    sheet = global_position(
        table(spark, sf, "part").selectExpr("p_partkey", "p_name kind", "p_brand `金额`", "p_type o_orderkey"),
        ["p_partkey"],
    )
    filled = fill_template(
        request=request_range(spark, REQUEST),
        table=table(spark, sf, "orders"),
        table_key=["o_orderkey"],
        chunks=_event_prose(spark, sf),
        chunk_key=["event_id"],
        template=sheet,
        header=header,
        kinds={"kind": "text", "金额": "number", "o_orderdate": "text"},
    )
    return filled.select(
        "pos",
        *[F.coalesce(F.col(c), F.lit("")).alias("amount" if c == "金额" else c) for c in header],
    )


QUERIES = {
    "template_fill": template_fill,
    "date_literals": date_literals_query,
    "request_ranges": request_ranges,
    "doc_date_range": doc_date_range,
    "range_filter_orders": range_filter_orders,
    "range_filter_events": range_filter_events,
    "range_filter_text_dates": range_filter_text_dates,
    "date_column_ratio": date_column_ratio,
    "template_project": template_project,
    "template_missing": template_missing,
    "conform_records": conform_records,
    "all_string_records": all_string_records,
    "merge_records": merge_records,
    "overlay_fill": overlay_fill,
    "multi_template_fill": multi_template_fill,
    "fill_many_in_place": fill_many_in_place,
    "empty_templates": empty_templates,
    "numbered_records": numbered_records,
    "first_occurrences": first_occurrences,
    "path_union": path_union,
    "paragraph_split": paragraph_split,
    "sentence_split": sentence_split,
    "clause_split": clause_split,
    "hard_cut": hard_cut,
    "semantic_chunks": semantic_chunks,
    "semantic_chunks_short": semantic_chunks_short,
    "semantic_chunks_long_first": semantic_chunks_long_first,
    "packed_paragraphs": packed_paragraphs,
    "token_windows": token_windows,
    "slice_documents": slice_documents,
    "fenced_text": fenced_text,
    "clean_text": clean_text,
    "path_parts": path_parts,
    "markdown_lines": markdown_lines,
    "markdown_tables": markdown_tables,
    "number_units": number_units,
    "mail_merge": mail_merge,
    "mail_merge_nested": mail_merge_nested,
    "long_numbers": long_numbers,
    "distant_numbers": distant_numbers,
    "first_filled_values": first_filled_values,
    "blank_line_paragraphs": blank_line_paragraphs,
    "han_bigrams": han_bigrams,
    "bm25_topk_large": bm25_topk_large,
    "lookup_default": lookup_default,
    "lookup_default_table": lookup_default_table,
    "reply_parse": reply_parse,
    "lenient_json": lenient_json,
    "extraction_prompts": extraction_prompts,
    "rule_records": rule_records,
    "rule_entities": rule_entities,
    "entity_pool": entity_pool,
    "bm25_stats": bm25_stats,
    "bm25_topk": bm25_topk,
    "bm25_all": bm25_all,
    "bm25_threshold": bm25_threshold,
    "vector_topk": vector_topk,
    "vector_threshold": vector_threshold,
    "field_match": field_match,
    "hybrid_rrf": hybrid_rrf,
    "hybrid_rrf_all": hybrid_rrf_all,
    "evidence": evidence,
    "evidence_hybrid": evidence_hybrid,
    "hit_counts": hit_counts,
    "vector_text_ids": vector_text_ids,
    "vector_left_out": vector_left_out,
    "sentence_nodes": sentence_nodes,
    "folder_search": folder_search,
    "stored_index": stored_index,
    "retrieval_chunks": retrieval_chunks,
    "workbook_cells": workbook_cells,
    "workbook_columns": workbook_columns,
    "workbook_markdown": workbook_markdown,
    "workbook_range": workbook_range,
    "docx_blocks": docx_blocks,
    "docx_slices": docx_slices,
    "decoded_texts": decoded_texts,
    "stored_records": stored_records,
    "job_report": job_report,
    "skip_existing": skip_existing,
    "run_stats": run_stats,
    **FOLDER_QUERIES,
}
