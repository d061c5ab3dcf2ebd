"""Functions on literal cases."""

import datetime as dt
import itertools
import random
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobtide import functions as fn
from jobtide.schema import RATES, RAW


def apply(spark, function, values, type_):
    schema = T.StructType([T.StructField("i", T.IntegerType()), T.StructField("v", type_)])
    df = spark.createDataFrame(list(enumerate(values)), schema)
    return [r[0] for r in df.orderBy("i").select(function(F.col("v"))).collect()]


SALARY = RAW["salary"].dataType


@pytest.mark.parametrize(
    ("salary", "expected"),
    [
        ((100000, 150000, "RUR"), 125000),
        ((1000, None, "USD"), 95000),
        (None, None),
        ((None, None, None), None),
        ((None, 150, "eur"), 15300),
        ((0, 200, "RUB"), 200),
        ((0, 0, "RUB"), None),
        ((1, 2, "RUB"), 1),
        ((-1, -2, "RUB"), -1),
        ((100, None, "GBP"), 100),
        ((100, None, None), 100),
        ((100, None, ""), 100),
        ((100, None, " USD"), 100),
        ((99, None, "KZT"), 19),
        ((2_000_000_000, None, "USD"), None),
        ((2_000_000_000, 2_000_000_000, "RUB"), 2_000_000_000),
    ],
)
def test_salary_cases(spark, salary, expected):
    assert apply(spark, fn.salary_rub, [salary], SALARY) == [expected]


def test_salary_grid(spark):
    bounds = [None, 0, 1, 2, 7, 99, 1001, 150_000, 2_147_483_647, -3, -150_000]
    currencies = [None, "", "RUR", "rub", "USD", "usd", "Eur", "KZT", "GBP", " USD"]
    grid = list(itertools.product(bounds, bounds, currencies))

    def plain(low, high, currency):
        given = [b for b in (low, high) if b]
        if not given:
            return None
        amount = int(sum(given) / len(given) * RATES.get((currency or "").upper(), 1.0))
        return amount if -(2**31) <= amount < 2**31 else None

    assert apply(spark, fn.salary_rub, grid, SALARY) == [plain(*g) for g in grid]


def test_skill_names(spark):
    cases = [
        [("Docker",), ("Kubernetes",), ("Python",)],
        [],
        None,
        [("a",), None, (None,)],
        [("b",), ("a",), ("b",), (" c ",)],
    ]
    assert apply(spark, fn.skill_names, cases, RAW["key_skills"].dataType) == [
        ["Docker", "Kubernetes", "Python"],
        [],
        [],
        ["a", None],
        ["b", "a", "b", " c "],
    ]


def test_skill_names_of_strings(spark):
    names = apply(
        spark,
        lambda c: fn.skill_names(c, of_structs=False),
        [["Linux", "Bash"], [None, "x"], None],
        T.ArrayType(T.StringType()),
    )
    assert names == [["Linux", "Bash"], ["x"], []]


def test_format_skills(spark):
    cases = [
        [" b", "a", "b ", "", "  "],
        None,
        [],
        ["\tЯндекс\n", "яндекс", "Zed", " a ", None, "a\x1f"],
        ["a b", "a  b"],
    ]
    assert apply(spark, fn.format_skills, cases, T.ArrayType(T.StringType())) == [
        ["a", "b"],
        [],
        [],
        ["Zed", "a", "Яндекс", "яндекс"],
        ["a  b", "a b"],
    ]


def test_format_skills_trims_what_python_trims(spark):
    blanks = [chr(c) for c in range(0x110000) if chr(c).isspace()]
    cases = [[f"{b}x{b}"] for b in blanks]
    trimmed = apply(spark, fn.format_skills, cases, T.ArrayType(T.StringType()))
    assert trimmed == [["x"]] * len(blanks)


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("<p>a</p><p>b &amp; c</p>", "ab &amp; c"),
        ("x<y <br/>z", "xz"),
        ("x<y <br\n/>z", "xz"),
        ("<>", "<>"),
        ("a < b", "a < b"),
        ("", ""),
        (None, None),
    ],
)
def test_strip_html(spark, text, expected):
    assert apply(spark, fn.strip_html, [text], T.StringType()) == [expected]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_published_date(spark, ansi):
    cases = [
        "2024-01-15T23:30:00-0800",
        "2024-01-15T10:30:00+0300",
        "2024-01-15",
        "bad",
        "",
        "2024-02-30",
        None,
    ]
    day = dt.date(2024, 1, 15)
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        found = apply(spark, fn.published_date, cases, T.StringType())
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
    assert found == [day, day, day, None, None, None, None]


def read_iso(text):
    try:
        read = dt.datetime.fromisoformat(text.replace("Z", "+00:00"))
    except ValueError:
        return None
    return read.astimezone(dt.UTC).replace(tzinfo=None) if read.tzinfo else read


def test_parse_timestamp(spark):
    cases = {
        "2024-01-15T10:30:00Z": "2024-01-15 10:30:00",
        "2024-01-15T10:30:00+03:00": "2024-01-15 07:30:00",
        "2024-01-15": "2024-01-15 00:00:00",
        "20240115T103000+0300": "2024-01-15 07:30:00",
        "2024-W03-1": "2024-01-15 00:00:00",
        "x": None,
        "": None,
        None: None,
    }
    found = apply(spark, fn.parse_timestamp, list(cases), T.StringType())
    assert {k: v and str(v) for k, v in zip(cases, found, strict=True)} == cases


def test_parse_timestamp_reads_what_python_reads(spark):
    days = [
        "2024-01-15", "20240115", "2024-02-29", "2023-02-29", "2024-13-01", "2024-1-5", "2024",
        "2024-01", " 2024-01-15", "2024-W03", "2024W03", "2024-W03-7", "2024W037", "2024W03-7",
        "2024-W037", "2020-W53-4", "2021-W53-4", "2024-W00", "2024-W03-0", "2024-W03-8",
        "2024-W01-1", "1999-12-31", "x", "",
    ]
    times = [
        "", "T10", "T1030", "T103059", "T10:30", "T10:30:59", " 10:30:59.25", "T10:30:59,123456",
        "T103059.5", "T10:30:59.1234567", "_10:30", "-10:30", "T10:3", "T1:30", "T25:00",
        "T10:60", "T10:3059", "T1030:59", "T",
    ]
    zones = ["", "Z", "+03", "+0300", "-05:30", "+03:00:30", "+3", "+25:00:0", "UTC"]
    texts = [d + t + z for d in days for t in times for z in zones]
    # A week and a time with a dash between them look like a week and a weekday.
    texts = [t for t in texts if not re.match(r"\d{4}-?W\d{2}-\d{2}", t)]
    found = apply(spark, fn.parse_timestamp, texts, T.StringType())
    wrong = {t: (f, read_iso(t)) for t, f in zip(texts, found, strict=True) if f != read_iso(t)}
    assert not wrong


def test_first_number(spark):
    cases = [
        "from 1,000 rub",
        "1,000 000 rub",
        "",
        None,
        "none",
        "-5.7",
        ", 12 ,3x4",
        "a1b2",
        "99999999999999999999",
        "00 7",
    ]
    found = apply(spark, fn.first_number, cases, T.StringType())

    def plain(text):
        digits = re.findall("[0-9]+", (text or "").replace(",", "").replace(" ", ""))
        return int(digits[0]) if digits and int(digits[0]) < 2**63 else None

    assert found == [plain(c) for c in cases]
    assert found[:2] == [1000, 1000000]


def test_has_keys(spark):
    cases = {
        '{"id": 1, "name": "x", "area": null}': True,
        '{"id": 1, "name": "x"}': False,
        '{"area": {"id": 1}, "name": "x"}': False,
        "{}": False,
        "[1]": False,
        "not json": False,
        None: False,
    }
    assert apply(spark, fn.has_keys, list(cases), T.StringType()) == list(cases.values())
    assert apply(spark, lambda c: fn.has_keys(c, ()), ["{}"], T.StringType()) == [True]


def test_detect_skills(spark):
    vocabulary = ("Docker", "C++", "C", "Go", "Google Cloud", "Cloud", ".NET", "Питон")
    cases = {
        "Знаем Docker, docker и DOCKER": ["Docker"],
        "dockerfile, godocker": [],
        "C++ and Go": ["C++", "C", "Go"],
        "Google Cloud": ["Google Cloud", "Cloud"],
        "ASP.NET (.net)": [".NET"],
        "питон3": [],
        "питон": ["Питон"],
        "": [],
    }
    found = apply(spark, lambda c: fn.detect_skills(c, vocabulary), list(cases), T.StringType())
    assert found == list(cases.values())
    assert apply(spark, lambda c: fn.detect_skills(c, ()), ["x"], T.StringType()) == [[]]


def test_or_now_and_processed_at(spark):
    given = dt.datetime(2024, 1, 1, 12)
    filled = apply(spark, fn.or_now, [given, None], T.TimestampType())
    assert filled[0] == given
    assert filled[1] > given
    times = spark.range(1000, numPartitions=4).select(fn.processed_at().alias("t"))
    assert times.distinct().count() == 1


def test_contains_text(spark):
    found = apply(
        spark, lambda c: fn.contains_text(c, "DevOps"), ["a DEVOPS b", "dev ops", None],
        T.StringType(),
    )
    assert found == [True, False, None]


def test_texts_that_defeat_a_backtracking_search(spark):
    opened = "<" * 500_000
    blank = "a" + " " * 500_000 + "b"
    assert apply(spark, fn.strip_html, [opened, f"<p>{opened}"], T.StringType()) == [opened] * 2
    found = apply(spark, fn.format_skills, [[blank, f" {blank} "]], T.ArrayType(T.StringType()))
    assert found == [[blank]]
    run = "1, " * 200_000
    assert apply(spark, fn.first_number, [run, " ," * 500_000], T.StringType()) == [None, None]
    word = "x" * 500_000 + "docker"
    detect = lambda c: fn.detect_skills(c, ("Docker",))
    assert apply(spark, detect, [word, "docker" * 100_000], T.StringType()) == [[], []]


def test_text_functions_on_random_text(spark):
    rng = random.Random(7)
    texts = ["".join(rng.choices("<>/ab 12,\n\té&;-", k=rng.randrange(25))) for _ in range(3000)]
    assert apply(spark, fn.strip_html, texts, T.StringType()) == [
        re.sub("<[^>]+>", "", t) for t in texts
    ]
    numbers = [re.findall("[0-9]+", t.replace(",", "").replace(" ", "")) for t in texts]
    expected = [int(n[0]) if n and int(n[0]) < 2**63 else None for n in numbers]
    assert apply(spark, fn.first_number, texts, T.StringType()) == expected
    lists = [t.split(",") for t in texts]
    assert apply(spark, fn.format_skills, lists, T.ArrayType(T.StringType())) == [
        sorted({s.strip() for s in skills if s.strip()}) for skills in lists
    ]
    words = [set(re.findall(r"[^\W_]+", t.lower())) for t in texts]
    assert [set(w) for w in apply(spark, fn.tokens, texts, T.StringType())] == words
