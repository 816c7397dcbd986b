"""Scalar functions against hand-made cases."""

import difflib
import html
import random
from html.entities import html5

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lumenfolio.functions import kernels as K
from lumenfolio.functions import text as X
from lumenfolio.functions.profiles import BANGLA_CORPUS, BANGLA_MATCH, LATIN, NormProfile


def one(spark, column, **values):
    row = {k: v for k, v in values.items()} or {"x": 1}
    kinds = ", ".join(f"{k} {'string' if isinstance(v, str) or v is None else 'array<string>' if isinstance(v, list) else 'int'}" for k, v in row.items())
    return spark.createDataFrame([tuple(row.values())], kinds).select(column.alias("v")).first()["v"]


def test_bangla_normalisation(spark):
    assert one(spark, X.normalize(F.col("t"), BANGLA_MATCH), t="আমি, ১২ শূন্য।") == "আমি 12 শুন্য"
    assert one(spark, X.normalize(F.col("t"), BANGLA_CORPUS), t="কৈ মৌ") == "কে মো"
    assert one(spark, X.normalize(F.col("t"), BANGLA_MATCH), t=None) == ""


def test_latin_profile_and_substitution(spark):
    assert one(spark, X.normalize(F.col("t")), t=" Étion,  the\tEND! ") == "étion the end"
    p = NormProfile(substitutions={"teh": "the"})
    assert one(spark, X.normalize(F.col("t"), p), t="teh tehs teh.") == "the tehs the"


def test_ordered_equivalences_chain(spark):
    assert one(spark, X.token_key(F.col("t")), t="কো") == "কা"
    assert one(spark, X.token_key(F.col("t")), t="য়") == "য"
    assert one(spark, X.loose_key(F.col("t")), t="মেঘের") == "মঘর"


def test_ngrams_of_short_texts(spark):
    assert one(spark, X.char_ngrams(F.col("t"), 3), t="ab") == []
    assert one(spark, X.char_ngrams(F.col("t"), 3), t="abcab") == ["abc", "bca", "cab"]
    assert one(spark, X.char_ngrams(F.col("t"), 2), t="é😀x") == ["é😀", "😀x"]


def test_lines_and_zones(spark):
    assert one(spark, X.lines(F.col("t")), t="a\r\nb\x0cc d\n") == ["a", "b", "c", "d"]
    z = one(spark, X.zones(F.col("t")), t="\n".join(f"l{i}" for i in range(10)))
    assert (z["header_text"], z["body_text"], z["footer_text"]) == ("l0\nl1\nl2\nl3", "l4\nl5", "l6\nl7\nl8\nl9")
    short = one(spark, X.zones(F.col("t")), t="a\n\nb")
    assert (short["header_text"], short["body_text"], short["footer_text"]) == ("a\nb", "a\nb", "a\nb")


def test_page_candidates_last_wins(spark):
    got = one(spark, X.page_candidates(F.col("t")), t="12\ntext\n* ১২ *\nmore\nlast\n7")
    assert [(c["value"], c["zone"], c["raw"]) for c in got] == [(12, "top", "* ১২ *"), (12, "bottom", "* ১২ *"), (7, "bottom", "7")]


def test_toc_entries(spark):
    got = one(spark, X.toc_entries(F.col("t")), t="First title .... 12 Second — 15")
    assert [(e["title"], e["page"]) for e in got] == [("First title", 12), ("Second", 15)]


def test_footer_page(spark):
    exact = X.footer_has_page(F.col("t"), F.lit(174))
    assert one(spark, exact, t="* ১৭৪") and not one(spark, exact, t="page 174 here")
    assert one(spark, X.footer_has_page(F.col("t"), F.lit(175), True), t="১৭৫৬") and not one(spark, exact, t="১৭৫৬")


@pytest.mark.parametrize(("text", "kinds"), [("12", {"western_alnum", "section_digit_line"}), ("-----", {"dash_divider"}), ("- ক", {"single_leading_dash"}), ("--ক", {"multi_leading_dash"}), ("—ক", {"leading_em_dash"}), ("ক১", {"inline_digit"}), ("", set())])
def test_line_issues(spark, text, kinds):
    assert set(one(spark, X.line_issues(F.col("t")), t=text)) == kinds


def test_markers(spark):
    text = "#one\nbody\nend"
    assert one(spark, X.embedded_marker(F.col("t"), ("one", "two")), t="#one\n#two") is None
    assert one(spark, X.unique_marker(F.col("a")), a=["x", "x"]) == "x" and one(spark, X.unique_marker(F.col("a")), a=["x", "y"]) is None


def test_title_similarity(spark):
    from lumenfolio.operators.matching import title_similarity

    v = one(spark, title_similarity(F.col("a"), F.col("b")), a="banalata sen", b="banalata sen")
    assert v == 1.0
    assert one(spark, title_similarity(F.col("a"), F.col("b")), a="", b="x") == 0.0


def test_samples_and_tags(spark):
    assert one(spark, X.sample_evenly(F.col("a"), 3), a=list("abcde")) == ["a", "c", "e"]
    rules = [("x", "t1"), ("y", "t2"), ("z", "t3")]
    assert one(spark, X.tag_rules(F.col("t"), rules, F.lit("c")), t="xyz") == ["c", "t1", "t2"]
    assert one(spark, X.tag_rules(F.col("t"), rules), t="q") == ["other"]


def test_html_and_urls(spark):
    html = "<p>a &amp; b</p><script>x()</script>"
    assert one(spark, X.html_text(F.col("t")), t=html) == "a & b x()"
    assert one(spark, X.html_text(F.col("t"), clean=True), t=html) == "a & b"
    assert one(spark, X.is_url(F.col("t")), t="https://a.org/b") and not one(spark, X.is_url(F.col("t")), t="a b")


def test_labels(spark):
    assert one(spark, X.page_label(F.col("t"), F.lit(3), F.lit(5)), t=None) == "3-5"
    assert one(spark, X.page_label(F.col("t"), F.lit(3), F.lit(3)), t=None) == "3"
    assert one(spark, X.page_label(F.col("t"), F.lit(3), F.lit(5)), t="iii") == "iii"
    assert one(spark, X.fold_letters(F.col("t")), t="য়া") == "যা"
    assert one(spark, X.feature_hash(F.col("t"), 1 << 40), t="exact:3:আমি") == 1350987635


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=9), st.lists(st.sampled_from("abc"), max_size=9))
def test_kernels_against_definitions(a, b):
    subs = {()}
    for x in a:
        subs |= {(*s, x) for s in subs}
    def inside(s):
        it = iter(b)
        return all(x in it for x in s)
    x, y = [K.code_points("".join(a))], [K.code_points("".join(b))]
    assert K.common_subsequences(x, y)[0] == max(len(s) for s in subs if inside(s))
    runs = [n for n in range(len(a) + 1) for i in range(len(a) - n + 1) for j in range(len(b) - n + 1) if a[i : i + n] == b[j : j + n]]
    assert K.common_runs(x, y)[0] == max(runs, default=0)
    assert K.gestalt_ratios(x, y)[0] == difflib.SequenceMatcher(None, "".join(a), "".join(b)).ratio()


def test_verse_blocks():
    assert K.verse_blocks_of("a\nb\n\n*\nc\n(note)\n") == [("stanza", "a\nb"), ("section-marker", "*"), ("stanza", "c"), ("source-note", "(note)")]


def test_line_scores(spark):
    from lumenfolio.operators import matching as M

    identity = ("",)
    assert round(one(spark, M.ordered_token_score(F.col("a"), F.col("b"), identity), a="aa bb cc dd", b="aa xx bb cc"), 6) == 0.70
    assert round(one(spark, M.fuzzy_line_score(F.col("a"), F.col("b"), 3, identity), a="abcdef", b="abcxef"), 6) == 0.34
    assert one(spark, M.fuzzy_line_score(F.col("a"), F.col("b"), 3, identity), a="ab", b="abc") is None
    assert LATIN.lower


@pytest.mark.parametrize("text, span, rest", [
    ("some verse (one)", " (one)", "some verse"), ("# one", "# one", ""), ("(one)\nlast", "(one)", "last"), ("first\nverse — [ one ] ", " — [ one ] ", "first\nverse"), ("verse  book: one", "  book: one", "verse"),
    ("verse ( one  collection )", " ( one  collection )", "verse"), ("one", None, "one"), ("(one) more", None, "(one) more"), ("(one)\n(two)", None, "(one)\n(two)"), ("a #one\nb", " #one", "a\nb"), ("collections: onef", None, "collections: onef"), (None, None, None),
])
def test_marker_spans(spark, text, span, rest):
    """The four forms stand at a line's end, also behind other text; only the span goes, and its line if nothing is left."""
    found = X.embedded_marker(F.col("t"), ("one", "two"))
    row = spark.createDataFrame([(text,)], "t string").select(found.alias("m"), X.without_span(F.col("t"), found).alias("rest")).first()
    assert (row.m.text if row.m else None, row.rest) == (span, rest)
    if row.m:
        line = text.split("\n")[row.m.line]
        assert line[row.m.start : row.m.start + row.m.length] == span


def test_character_references(spark):
    """Any names, with and without semicolon, and any numbers, as the standard library resolves them."""
    rnd = random.Random(6)
    names, rows = sorted(html5), []
    odd = ["&", "&;", "&#", "&#x", "&#;", "&amp", "&amplt;", "&notit;", "&nosuch;", "&copy2", "&AMP;lt;", "&#0;", "&#13;", "&#128;", "&#x9f;", "&#x81;", "&#55296;", "&#1114112;", "&#99999999999999999999;", "&#x110000;", "&#xfdd0;", "&#1;", "&#127;", "&#x1F600;", "&#00065", "&eacute;", "&#233;", "&mdash;", "&acE;"]
    for _ in range(60):
        parts = rnd.choices(odd, k=3) + ["&" + n for n in rnd.sample(names, 30)] + [f"&#{rnd.randrange(1 << rnd.randint(1, 21))}{rnd.choice(['', ';'])}" for _ in range(10)] + [f"&#{rnd.choice('xX')}{rnd.randrange(1 << 21):x};" for _ in range(10)]
        parts = [p + rnd.choice(["", " ", "x", "1", ";", "é"]) for p in parts]
        rnd.shuffle(parts)
        rows.append("".join(parts))
    rows += ["", "no references", None, *odd]
    t = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, t string")
    got = {r.i: r.u for r in t.select("i", X.unescape(F.col("t")).alias("u")).collect()}
    for i, r in enumerate(rows):
        assert got[i] == (html.unescape(r) if r is not None else None), r
