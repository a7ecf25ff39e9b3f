import pytest
from pyspark.sql import functions as F

from formweave.functions.chunks import pack, packed_paragraphs, semantic_chunks, token_windows
from formweave.functions.dates import date_literals, date_range, iso_date, parse_date, to_moment
from formweave.functions.jsontext import parse_object, parse_objects, parse_record_list, strip_fence
from formweave.functions.numbers import amount, amounts, plain_number
from formweave.functions.text import (
    any_filled,
    clauses,
    clean,
    fence,
    file_name,
    first_filled,
    hard_cut,
    is_blank,
    paragraphs,
    preview,
    relative_to,
    render,
    sentences,
    stem,
    strip,
    suffix,
    unbold,
    with_suffix,
    words,
    words_and_bigrams,
)
from formweave.functions.vectors import cosine

L = F.lit


def found(value, text):
    return [(x["literal"], str(x["day"])) for x in value(date_literals(L(text)))]


def test_literals_of_all_forms(value):
    text = "报告期 2020-07-01 至 2020/8/31，见 31.08.2020 与 02/30/2020"
    assert found(value, text) == [
        ("2020-07-01", "2020-07-01"), ("2020/8/31", "2020-08-31"), ("31.08.2020", "2020-08-31"),
    ]
    assert found(value, "7-1-2020 and 07/02/2020, 2020年7月3日") == [
        ("7-1-2020", "2020-07-01"), ("07/02/2020", "2020-07-02"), ("2020年7月3日", "2020-07-03"),
    ]


def test_literal_bounds(value):
    assert found(value, "12020-07-01") == []
    assert found(value, "2020-07-011") == []
    assert found(value, "0000-01-01 and 2021-02-29") == []
    assert found(value, "x2020-7-1x") == [("2020-7-1", "2020-07-01")]
    assert found(value, "2020-7-1\n2020-7-2") == [("2020-7-1", "2020-07-01"), ("2020-7-2", "2020-07-02")]
    assert found(value, "２０２０-０７-０１") == [("２０２０-０７-０１", "2020-07-01")]
    assert found(value, "９2020-07-01") == []
    # Literals of two forms may share digits.
    assert found(value, "1-2-2020-3-4") == [("2020-3-4", "2020-03-04"), ("1-2-2020", "2020-01-02")]


def test_ranges(value):
    def of(text):
        r = value(date_range(date_literals(L(text))))
        return r["n_literals"], str(r["start_date"]), str(r["end_date"])

    assert of("2020-07-01 2020/07/01") == (2, "2020-07-01", "2020-07-01")
    assert of("only 2020-07-01, 2020-07-01") == (1, "None", "None")
    assert of("b 2021/1/2 a 2020-07-01 c 3.4.2022") == (3, "2020-07-01", "2022-04-03")
    assert value(iso_date(parse_date(L("am 5.6.2020")))) == "2020-06-05"


@pytest.mark.parametrize(
    "text, moment",
    [
        ("2020-07-01", "2020-07-01 00:00:00"), ("2020-07-01 10:30:00", "2020-07-01 10:30:00"), ("2020", "2020-01-01 00:00:00"),
        ("2020/7/1 09:00", "2020-07-01 09:00:00"), ("7/1/2020", "2020-07-01 00:00:00"), ("2020年7月1日", "2020-07-01 00:00:00"),
        ("20200701", "2020-07-01 00:00:00"), ("20201301", None), ("1 July 2020", "2020-07-01 00:00:00"),
        ("01-Jul-2020 08:00", "2020-07-01 08:00:00"), ("Aug 31, 2020", "2020-08-31 00:00:00"), ("1 Foo 2020", None), ("1 anf 2020", None), ("1677", None), ("1678", "1678-01-01 00:00:00"), ("1066-10-14", "1066-10-14 00:00:00"), ("0042", None), ("9999-12-31", "9999-12-31 00:00:00"), ("2 dec 2020", "2020-12-02 00:00:00"),
        ("31.08.2020", "2020-08-31 00:00:00"), ("12:30", None), ("bad", None), ("2020-13-01", None), ("17", None),
    ],
)
def test_moments(value, text, moment):
    assert value(F.date_format(to_moment(L(text)), "yyyy-MM-dd HH:mm:ss")) == moment


def test_text_splits(value):
    assert value(paragraphs(L("p1\n\n p2 \n　\n\n\np3"))) == ["p1", "p2", "p3"]
    assert value(sentences(L("一。二！ 三?! four."))) == ["一。", "二！", " 三?", "!", " four."]
    assert value(clauses(L("a,b，c"))) == ["a,", "b，", "c"]
    assert value(hard_cut(L("abc\ndefg"), 3)) == ["abc", "\nde", "fg"]
    assert value(hard_cut(L(""), 3)) == []
    assert value(hard_cut(L("😀😀😀"), 2)) == ["😀😀", "😀"]
    assert value(strip(L("　  x y \x1c\n"))) == "x y"
    assert value(is_blank(L("　\x1f "))) and not value(is_blank(L("​")))


def test_semantic_chunks(value):
    assert value(semantic_chunks(L("一二。三四。五六七八九。"), 6)) == ["一二。三四。", "五六七八九。"]
    text = L("甲。一二三，四五六，七八。")
    assert value(semantic_chunks(text, 6)) == ["甲。一二三，", "四五六，", "七八。"]
    assert value(semantic_chunks(text, 6, pack_clauses=False)) == ["甲。", "一二三，", "四五六，", "七八。"]
    assert value(semantic_chunks(text, 6, long_first=True)) == ["一二三，", "四五六，", "七八。", "甲。"]
    assert value(semantic_chunks(L("abcdefgh,"), 5)) == ["abcde", "fgh,"]
    assert value(semantic_chunks(L("short。text"), 1000)) == ["short。text"]
    assert value(semantic_chunks(L("        "), 5)) == ["     ", "   "]


def test_chunk_properties(spark):
    """Whatever the limit: no chunk too long, and no text lost or moved."""
    seed = "甲乙，丙。丁 戊！a,b?" * 40 + "x" * 50 + "，" + "y" * 33 + "。"
    df = spark.range(1, 40).select(F.col("id"), L(seed).alias("t"))
    for limit in (1, 3, 7, 20, 64):
        c = semantic_chunks(F.substring("t", F.lit(1), F.col("id").cast("int") * 11), limit)
        bad = df.filter(
            (F.array_join(c, "") != F.substring("t", F.lit(1), F.col("id").cast("int") * 11))
            | F.exists(c, lambda x: F.length(x) > limit)
        )
        assert bad.count() == 0, limit


def test_packing(value):
    assert value(packed_paragraphs(L("aaaa\n\nbbb\n\ncccccccccccc\n\ndd"), 10)) == ["aaaa\n\nbbb", "cccccccccc", "cc\n\ndd"]
    assert value(packed_paragraphs(L("abcdefghij"), 5)) == ["abcde", "fghij"]
    assert value(packed_paragraphs(L("  \n \n  "), 50)) == []
    assert value(packed_paragraphs(L("ab\n\n\n\ncd"), 3)) == ["ab", "cd"]
    assert value(pack(F.array(L("a"), L("b"), L("ccc")), 3, "-")) == ["a-b", "ccc"]


@pytest.mark.parametrize("n, sizes", [(0, []), (1, [1]), (512, [512]), (513, [512, 51]), (1000, [512, 512, 76])])
def test_windows(value, n, sizes):
    tokens = F.transform(F.sequence(L(1), L(max(n, 1))), lambda x: x.cast("string"))
    got = value(token_windows(F.slice(tokens, 1, n)))
    assert [len(w) for w in got] == sizes
    if len(got) > 1:
        assert got[0][-50:] == got[1][:50]


def test_markers(value):
    assert value(fence(L("x"))) == "```text\nx\n```"
    assert value(unbold(L("**湖北省** a * b **c**"))) == "湖北省 a * b c"
    assert value(preview(L("x" * 200))) == "x" * 100
    assert value(clean(L("a\x00  b \n　c� "))) == "a b\nc"
    assert value(render(L("{{ n }}|{{n}}|{{ m }}"), {"n": L("$1\\"), "x": L(1)})) == "$1\\|$1\\|{{ m }}"
    values = {"a": L("{{ b }}"), "b": L("secret")}
    assert value(render(L("A {{ a }} B {{ b }}"), values)) == "A {{ b }} B secret"
    with pytest.raises(ValueError):
        render(L(""), {"a\\E": L(1)})


def test_paths(value):
    assert value(file_name(L("/a/b.c/d.tar.gz"))) == "d.tar.gz"
    assert value(stem(L("/a/b.c/d.tar.gz"))) == "d.tar"
    assert value(stem(L("/a/.hidden"))) == ".hidden" and value(suffix(L("/a/.hidden"))) == ""
    assert value(suffix(L("x.TXT"))) == ".txt"
    assert value(with_suffix(L("/a.b/c"), ".md")) == "/a.b/c.md"
    assert value(with_suffix(L("/a.b/c.docx"), ".md")) == "/a.b/c.md"
    assert value(relative_to(L("/a/b/c.d"), "/a/")) == "b/c.d"


def test_tokens(value):
    assert value(words(L("  a b　c\n"))) == ["a", "b", "c"]
    assert value(words(L(""))) == []
    assert value(words_and_bigrams(L("合同金额 is 5 元 ok"))) == ["合同", "同金", "金额", "is", "5", "元", "ok"]


def test_filled(value):
    empty, none = L(""), L(None).cast("string")
    assert value(any_filled([empty, none, L("x")])) and not value(any_filled([empty, none]))
    assert value(first_filled([empty, none, L("x")])) == "x" and value(first_filled([empty])) == "?"


@pytest.mark.parametrize(
    "text, number",
    [
        ("约 5775 万人", "57750000"), ("1,234 元", "1234"), ("3 亿", "300000000"), ("全零报告", "0"), ("今日无新增 5", "0"),
        ("none", ""), ("-1.50 万", "-15000"), ("1.25万亿", "1250000000000"), ("0.0500", "0.05"), ("100", "100"), ("10.", "10"),
    ],
)
def test_numbers(value, text, number):
    assert value(plain_number(L(text))) == number


def test_amounts(value):
    text = L("合同 12 份，金额 3.5万元，另 1,000 美元")
    assert value(amounts(text)) == ["3.5万元", "1,000 美元"]
    assert value(amount(text)) == "35000"
    assert value(amount(L("12 份"))) == ""


def test_json_objects(value):
    assert value(parse_objects(L('{"text":"a"},{"text":"b"},'))) == [{"text": "a"}, {"text": "b"}]
    for broken in ('{"text":"a"}\n{"text":"b"}', '[{"a":1}] x', '[{"a":1', "", "nope", "{'a':1}"):
        assert value(parse_objects(L(broken))) == [], broken
    assert value(parse_objects(L('[{"a":{"b":[1]}}]'))) == [{"a": '{"b":[1]}'}]
    assert value(parse_record_list(L('{"a":1}'))) == []
    assert value(parse_object(L(' {"a":1,"b":null} '))) == {"a": "1", "b": None}
    for broken in ('{"a":1} x', "[1]", '{"a":1},{"b":2}', "", '"s"'):
        assert value(parse_object(L(broken))) is None, broken


def test_fences(value):
    assert value(strip_fence(L('```json\n{"a":1}\n```'))) == '{"a":1}'
    assert value(strip_fence(L(" ```x``` "))) == "```x```"
    assert value(strip_fence(L("```\r\na\r\n\r\nb\r\n```\n"))) == "a\n\nb"
    assert value(strip_fence(L(" plain "))) == "plain"


def test_cosine(value):
    a, b, zero = F.array(L(1.0), L(0.0)), F.array(L(1.0), L(1.0)), F.array(L(0.0), L(0.0))
    assert value(F.round(cosine(a, b), 6)) == 0.707107
    assert value(cosine(a, zero)) is None
