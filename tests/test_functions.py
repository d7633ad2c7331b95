"""Scalar functions on values, one Spark row per case."""

from __future__ import annotations

import random
from urllib.parse import parse_qsl, urlencode

import pytest
from pyspark.sql import functions as F

from newsloom.functions import dates, feeds, text, urls, vocabulary
from newsloom.lexicon import DEFAULT_LEXICON


def values(spark, fn, inputs, kind="string"):
    rows = [(i, v) for i, v in enumerate(inputs)]
    df = spark.createDataFrame(rows, f"i int, v {kind}")
    return [r[0] for r in df.select("i", fn(F.col("v")).alias("o")).orderBy("i").select("o").collect()]


def test_canonical_url_examples(spark):
    cases = {
        "HTTPS://WWW.Example.com/Path/?utm_source=rss&id=7&fbclid=z#frag": "https://example.com/Path?id=7",
        None: None,
        "": None,
        "http://a.example": "http://a.example/",
        "http://a.example//": "http://a.example/",
        " http://a.example/x?b=2&a=1 ": "http://a.example/x?b=2&a=1",
        "http://a.example/x?a&b=": "http://a.example/x?a=&b=",
        "http://a.example/x?q=%zz%4&s=~*": "http://a.example/x?q=%25zz%254&s=~%2A",
        "http://a.example/x?SH=1&Itok=2&at_x=3&k=a+b": "http://a.example/x?k=a+b",
        "http://[bad/x": "http://[bad/x",
        "mailto:someone@a.example": "mailto:someone@a.example",
        "/only/path/": "/only/path",
        "http://a.example?x=1": "http://a.example/?x=1",
    }
    assert values(spark, urls.canonicalize_url, cases) == list(cases.values())


def test_query_encoding_equals_form_encoding(spark):
    rnd = random.Random(3)
    alphabet = "aZ09 +%&=~*-._!'()/?:@é漢;,$%2%41"
    queries = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 25))) for _ in range(400)]
    expected = [urlencode([(k, v) for k, v in parse_qsl(q, keep_blank_values=True)
                           if not k.lower().startswith(urls.TRACKING_PREFIXES)
                           and k.lower() not in urls.TRACKING_KEYS]) for q in queries]
    assert values(spark, urls.clean_query, queries) == expected


def test_relay_url_leaves_slashes(spark):
    out = values(spark, urls.relay_url, ["site:a.example/b (x OR y)"])[0]
    assert out == ("https://news.google.com/rss/search?q=site%3Aa.example/b%20%28x%20OR%20y%29"
                   "&hl=en-GB&gl=GB&ceid=GB:en")


def test_parse_datetime(spark):
    cases = {
        "Wed, 06 Aug 2025 14:03:11 +0000": "2025-08-06 14:03:11",
        "6 Aug 2025 14:03:11 EST": "2025-08-06 19:03:11",
        "06 Aug 25 14:03 GMT": "2025-08-06 14:03:00",
        "Wed, 06 Aug 70 14:03:11 -0730": "1970-08-06 21:33:11",
        "2025-08-06T14:03:11Z": "2025-08-06 14:03:11",
        "2025-08-06T14:03:11+02:00": "2025-08-06 12:03:11",
        "2025-08-06": "2025-08-06 00:00:00",
        "20250806T140311Z": "2025-08-06 14:03:11",
        "2025-08-06T14:03:11 somewhere": "2025-08-06 14:03:11",
        "2025-08-06 or so": "2025-08-06 00:00:00",
        "31 Feb 2025 10:00:00 GMT": None,
        "2025": None, "2025-08": None, "12:30": None, "not a date": None, "": None, None: None,
    }
    out = values(spark, lambda c: F.date_format(dates.parse_datetime(c), "yyyy-MM-dd HH:mm:ss"), cases)
    assert dict(zip(cases, out)) == cases


def test_date_from_html(spark):
    out = values(spark, lambda c: dates.iso_utc(dates.date_from_html(c)),
                 ['<p><time datetime="2026-08-03T10:56:46+02:00">3 August</time>', "<time>none</time>"])
    assert out == ["2026-08-03T08:56:46+00:00", None]


def test_strip_html(spark):
    cases = {"<p>a&nbsp;b</p>\n<b>c</b>": "a b c", "&amp;lt;x&amp;gt;": "<x>", "&quot;q&quot; &#39;": "\"q\" '",
             "a  b": "a b", "<br>": None, "": None, None: None}
    assert values(spark, text.strip_html, cases) == list(cases.values())


def test_title_key(spark):
    cases = {"EU's Net-Zero: plan!": "eu s net zero plan", "気候": "", None: ""}
    assert values(spark, text.title_key, cases) == list(cases.values())


def test_clean_labels(spark):
    labels = [" b ", "a", "b", "", None] + [f"z{i:02d}" for i in range(20)]
    out = values(spark, text.clean_labels, [labels], "array<string>")[0]
    assert out == ["a", "b"] + [f"z{i:02d}" for i in range(10)]


@pytest.mark.parametrize("title,publisher,expected", [
    ("Bridge opens in the EU - quay.example", "quay.example", "Bridge opens in the EU"),
    ("Bridge opens - the EU", "", "Bridge opens"),
    ("Ferries - how the new timetable changes island life", None,
     "Ferries - how the new timetable changes island life"),
    ("Ferries - post.example", None, "Ferries"),
    ("Plain", None, "Plain"),
])
def test_publisher_suffix(spark, title, publisher, expected):
    df = spark.createDataFrame([(title, publisher)], "t string, p string")
    assert df.select(feeds.strip_publisher_suffix(F.col("t"), F.col("p"))).first()[0] == expected


BODY = ("By 09:41 UTC the TNFD and CSDDD tables were filed in the EU and the US. PCAF and ISSB count financed "
        "emissions; a carbon credit pays for green hydrogen. The yard, run by SKF, has a net-zero date and reports "
        "Scope 1 and Scope 2 emissions.")


def test_extract_terms(spark):
    terms = values(spark, text.extract_terms, [BODY])[0]
    assert {"TNFD", "CSDDD", "PCAF", "ISSB", "SKF", "financed emissions", "carbon credit",
            "green hydrogen", "net-zero", "Scope 1 and 2 emissions"} == set(terms)
    assert terms == sorted(terms, key=str.lower)
    assert values(spark, text.extract_terms, ["scope 3 only"])[0] == ["Scope 3 emissions"]


def test_signature_stop_words_before_plural(spark):
    df = spark.createDataFrame([("The Banks and its bass $400M ass", "Banking as was " + "x" * 300)],
                               "t string, s string")
    got = df.select(text.token_signature(F.col("t"), F.col("s"))).first()[0]
    assert got[:5] == ["bank", "ba", "$400m", "a", "banking"]
    assert len(got) == 6 and len(got[5]) == 200 - len("Banking as was ")


def test_vocabulary_scan_equals_substring_tests(spark):
    rnd = random.Random(5)
    words = sorted(set(vocabulary._literals(DEFAULT_LEXICON)))
    texts = []
    for _ in range(300):
        picks = [rnd.choice(words) for _ in range(rnd.randint(0, 6))]
        picks = [p[rnd.randint(0, 2):] + rnd.choice(["", " ", "s", p[:3]]) for p in picks]
        texts.append(rnd.choice(["", " "]).join(picks))
    got = values(spark, lambda c: vocabulary.lexicon_hits(c, DEFAULT_LEXICON), texts)
    assert [set(g) for g in got] == [{w for w in words if w in t} for t in texts]
    assert all(len(g) == len(set(g)) for g in got)


def test_words_of_any_width_come_sorted_and_stay_in_their_text(spark):
    words = ["eu", "é", "solar", "sol", "ar p", "larp"]
    texts = ["solar panel", "", None, "sol", "ar", "par per caf\u00e9", "larpeu" * 3, "x" * (1 << 20) + " solar", "e", "u"]
    got = values(spark, lambda c: vocabulary.words_in(c, words), texts)
    assert got == [None if t is None else sorted(w for w in words if w in t) for t in texts]
    assert values(spark, lambda c: vocabulary.words_in(c, []), ["a", ""]) == [[], []]


def test_dates_agree_with_the_mail_library(spark):
    from datetime import datetime, timezone
    from email.utils import mktime_tz, parsedate_tz
    rnd = random.Random(8)
    forms = ["%a, %d %b %Y %H:%M:%S +0000", "%d %b %Y %H:%M:%S GMT", "%a %b %e %H:%M:%S %Y", "%b %d %Y %H:%M:%S +0000",
             "%a, %b %d %Y %H:%M:%S GMT", "%a, %d %b %Y %H.%M.%S GMT", "%d %b %Y %H:%M -0330", "%a, %d %b %Y %H:%M EST",
             "%b %d, %Y %H:%M:%S +0200", "%A, %d %B %Y %H:%M:%S Z", "%d-%b-%Y %H:%M:%S PDT"]
    texts = [datetime.fromtimestamp(rnd.randrange(10**9, 2 * 10**9), timezone.utc).strftime(rnd.choice(forms))
             for _ in range(400)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = [r.s for r in df.select("i", F.unix_timestamp(dates.parse_datetime(F.col("t"))).alias("s")).orderBy("i").collect()]
    assert [(t, s) for t, s in zip(texts, got)] == [(t, mktime_tz(parsedate_tz(t))) for t in texts]


def test_iso_dates_agree_with_the_standard_library(spark):
    from datetime import datetime, timedelta, timezone
    rnd = random.Random(9)
    times = [datetime.fromtimestamp(rnd.randrange(10**9, 2 * 10**9), timezone(timedelta(minutes=rnd.choice([0, 120, -330]))))
             for _ in range(200)]
    texts = [t.isoformat() if i % 2 else t.strftime("%Y%m%dT%H%M%S%z") for i, t in enumerate(times)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = [r.s for r in df.select("i", F.unix_timestamp(dates.parse_datetime(F.col("t"))).alias("s")).orderBy("i").collect()]
    assert got == [int(t.timestamp()) for t in times]
