"""Scalar text functions as Column expressions (T1-T65, without the UDF kernels)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .entities import SPACES, unescape
from .profiles import ASCII_DIGITS, BANGLA_CLASSES, BANGLA_DIGITS, LATIN, LEXICON_EQUIVALENCES, LOOSE_MARKS, NOISE_FRAGMENTS, ZERO_WIDTH, NormProfile

#: White space as an explicit class, equal in Java, RE2 and here.
WS = r"[ \t\n\r\f\x0b]"
LINE_BREAK = r"\r\n|[\n\x0b\x0c\r\x1c-\x1e\x{85}\x{2028}\x{2029}]"


def let(value: Column, body) -> Column:
    """``body`` of a value worked out once, even where lambdas use it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def no_strings() -> Column:
    return F.array().cast("array<string>")


def drop_zero_width(text: Column) -> Column:
    return F.regexp_replace(text, "[" + "".join(ZERO_WIDTH) + "]", "")


def collapse(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, f"{WS}+", " "))


def replace_all(text: Column, pairs: Sequence[tuple[str, str]]) -> Column:
    """Replacements one after the other; a later one sees what an earlier one made."""
    return reduce(lambda t, p: F.replace(t, F.lit(p[0]), F.lit(p[1])), pairs, text)


def equivalence_pairs(groups: Sequence[tuple[str, ...]]) -> list[tuple[str, str]]:
    return [(variant, group[0]) for group in groups for variant in group[1:]]


def substitute_words(text: Column, table: dict[str, str] | Column) -> Column:
    """Words found in the map are replaced, everything else stays."""
    known = table if isinstance(table, Column) else F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    parts = F.split(text, r"(?<=[\p{L}\p{M}\p{N}])(?![\p{L}\p{M}\p{N}])|(?<![\p{L}\p{M}\p{N}])(?=[\p{L}\p{M}\p{N}])")
    return F.array_join(F.transform(parts, lambda w: F.coalesce(F.try_element_at(known, w), w)), "")


def _folded(text: Column, profile: NormProfile) -> Column:
    """The first steps of T1: one translation drops zero-width characters and makes digits ASCII; then lower case."""
    digits = (BANGLA_DIGITS, ASCII_DIGITS) if profile.digits else ("", "")
    t = F.translate(F.coalesce(text, F.lit("")), digits[0] + "".join(ZERO_WIDTH), digits[1])
    return F.lower(t) if profile.lower else t


def normalize(text: Column, profile: NormProfile = LATIN) -> Column:
    """Normalised text; null becomes an empty text."""
    t = _folded(text, profile)
    if not profile.substitutions and not profile.equivalences:  # white space is no more kept than the rest, so one pass is enough
        return F.trim(F.regexp_replace(t, f"[^{profile.keep}]+", " "))
    t = F.regexp_replace(t, f"[^{profile.keep} \\t\\n\\r\\f\\x0b]+", " ")
    t = substitute_words(t, profile.substitutions) if profile.substitutions else t
    return collapse(replace_all(t, equivalence_pairs(profile.equivalences)))


def normal_lines(text: Column, profile: NormProfile = LATIN) -> Column:
    """The normalised lines of a text, without empty ones.

    The text is normalised as one, but for its line breaks, where what is kept holds no line
    break and no rule reaches over one; so no expression is worked out line by line.
    """
    if profile.substitutions or profile.equivalences:
        return F.filter(F.transform(lines(text), lambda x: normalize(x, profile)), lambda x: x != "")
    breaks = r"\n\x0b\x0c\r\x1c-\x1e\x{85}\x{2028}\x{2029}"
    whole = F.trim(F.regexp_replace(_folded(text, profile), f"[^{profile.keep}{breaks}]+", " "))
    return F.filter(F.split(whole, f" *[{breaks}][{breaks} ]*"), lambda x: x != "")


def compact(text: Column, profile: NormProfile | None = LATIN) -> Column:
    """T4: normalised (unless ``profile`` is None) and without white space."""
    return F.regexp_replace(normalize(text, profile) if profile else F.coalesce(text, F.lit("")), f"{WS}+", "")


def normalize_spacing(text: Column) -> Column:
    """T5."""
    return collapse(drop_zero_width(F.coalesce(text, F.lit(""))))


def class_signature(text: Column, groups: Sequence[str] = BANGLA_CLASSES) -> Column:
    """Each letter of a group becomes the group's private-use character."""
    letters = "".join(groups)
    return F.translate(text, letters, "".join(chr(0xE000 + i) for i, g in enumerate(groups) for _ in g))


def char_ngrams(text: Column, n: int) -> Column:
    """Character n-grams in order; none for a text shorter than n.

    The text is cut into characters once, so the cost grows with its length
    and not with its square.
    """
    cut = lambda c: F.transform(F.sequence(F.lit(1), F.size(c) - (n - 1)), lambda i: F.array_join(F.slice(c, i, n), ""))
    return F.when(F.length(text) >= n, let(F.split(text, ""), cut)).otherwise(no_strings())


def char_ngram_set(text: Column, n: int) -> Column:
    """T8."""
    return F.array_distinct(char_ngrams(text, n))


def words(normal: Column) -> Column:
    """Words of a normalised text; none for an empty one."""
    return let(normal, lambda n: F.when(n == "", no_strings()).otherwise(F.split(n, " ")))


def token_set(normal: Column, least: int = 3) -> Column:
    """Distinct words of at least ``least`` characters."""
    return F.array_distinct(F.filter(words(normal), lambda w: F.length(w) >= least))


def token_list(normal: Column, least: int = 2) -> Column:
    """Numbers, and words of at least ``least`` characters, in order with repeats."""
    return F.filter(words(normal), lambda w: w.rlike("^[0-9]+$") | (F.length(w) >= least))


def phrase_tokens(normal: Column, least: int = 2) -> Column:
    """Words of at least ``least`` characters that aren't numbers, in order."""
    return F.filter(words(normal), lambda w: ~w.rlike("^[0-9]+$") & (F.length(w) >= least))


def lexicon_words(text: Column, least: int = 3, letters: str = r"ঀ-৿", noise: Sequence[str] = NOISE_FRAGMENTS) -> Column:
    """Runs of letters, without short ones, numbers and noise; order and repeats kept."""
    found = F.regexp_extract_all(normalize_spacing(text), F.lit(f"[{letters}]+"), 0)
    digits = f"^[{BANGLA_DIGITS}0-9]+$"
    keep = lambda w: (F.length(w) >= least) & ~w.rlike(digits) & (~w.isin(list(noise)) if noise else F.lit(True))
    return F.filter(found, keep)


def token_windows(tokens: Column, sizes: Sequence[int] = (6, 5, 4)) -> Column:
    """struct(start, size, phrase) of all windows, larger sizes first."""

    def of_size(t: Column, n: int) -> Column:
        made = F.transform(F.sequence(F.lit(0), F.size(t) - n), lambda i: F.struct(i.alias("start"), F.lit(n).alias("size"), F.array_join(F.slice(t, i + 1, n), " ").alias("phrase")))
        return F.when(F.size(t) >= n, made).otherwise(F.array().cast("array<struct<start:int,size:int,phrase:string>>"))

    return let(tokens, lambda t: F.concat(*(of_size(t, n) for n in sizes)))


def token_key(token: Column, groups: Sequence[tuple[str, ...]] = LEXICON_EQUIVALENCES) -> Column:
    """Digits to ASCII, then ordered replacements (which may chain)."""
    return replace_all(F.translate(token, BANGLA_DIGITS, ASCII_DIGITS), equivalence_pairs(groups))


def loose_key(token: Column, groups: Sequence[tuple[str, ...]] = LEXICON_EQUIVALENCES, marks: str = LOOSE_MARKS) -> Column:
    """The key without vowel signs."""
    return F.regexp_replace(token_key(token, groups), marks, "")


def to_bangla_digits(value: Column) -> Column:
    """T16; null stays null."""
    return F.translate(value.cast("string"), ASCII_DIGITS, BANGLA_DIGITS)


def from_bangla_digits(text: Column) -> Column:
    """The number that the digits of a text form, or null."""
    return F.regexp_replace(F.translate(text, BANGLA_DIGITS, ASCII_DIGITS), "[^0-9]", "").try_cast("int")


def page_number(text: Column, most: int = 500) -> Column:
    """A text of digits only, from 1 to ``most``, or null."""
    plain = F.translate(text, BANGLA_DIGITS, ASCII_DIGITS)
    number = F.when(plain.rlike("^[0-9]+$"), plain.try_cast("int"))
    return F.when(number.between(1, most), number)


def stable_id(*parts: Column) -> Column:
    """The first 12 hexadecimal digits of the SHA-1 of ``a::b``."""
    return F.substring(F.sha1(F.concat_ws("::", *parts)), 1, 12)


def strip_standalone_digits(text: Column) -> Column:
    """T19."""
    return F.trim(F.regexp_replace(text, r"(^|[ \t\n\r\f\x0b])[0-9]+(?=[ \t\n\r\f\x0b]|$)", " "))


def toc_title(text: Column) -> Column:
    """Without parentheses, dots and dashes of leaders, and digits at the edges."""
    t = F.regexp_replace(F.coalesce(text, F.lit("")), r"\([^)]*\)", " ")
    t = F.regexp_replace(t, r"[.·•…_\-–—:;|]+", " ")
    edge = f"[{BANGLA_DIGITS}0-9 \\t]+"
    return collapse(F.regexp_replace(t, f"^{edge}|{edge}$", " "))


def compact_digits(text: Column) -> Column:
    """Without punctuation and white space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\p{P}\p{S}\s]+", "")


def keyword_context(text: Column, word: Column, around: int = 36) -> Column:
    """The first hit with so many characters on either side, or an empty text."""
    at = F.position(word, text)
    start = F.greatest(at - around, F.lit(1))
    return F.when(at > 0, F.substring(text, start, at - start + F.length(word) + around)).otherwise("")


def lines(text: Column) -> Column:
    """Lines by all line breaks, without an empty last one."""
    parts = F.split(F.coalesce(text, F.lit("")), LINE_BREAK)
    return F.when(F.element_at(parts, -1) == "", F.slice(parts, F.lit(1), F.size(parts) - 1)).otherwise(parts)


def lines_with(text: Column, word: Column, most: int) -> Column:
    """struct(line, text) of the first lines that hold a word, counted from 1."""
    numbered = F.transform(lines(text), lambda x, i: F.struct((i + 1).alias("line"), x.alias("text")))
    return F.slice(F.filter(numbered, lambda s: F.contains(s["text"], word)), 1, most)


def html_text(html: Column, clean: bool = False) -> Column:
    """Tags become spaces, character references are resolved, white space collapses.

    Text of scripts and styles stays, unless ``clean`` (an extension).
    """
    t = F.coalesce(html, F.lit(""))
    t = F.regexp_replace(t, r"(?is)<(script|style)\b.*?</\1>", " ") if clean else t
    return F.trim(F.regexp_replace(unescape(F.regexp_replace(t, "<[^>]+>", " ")), SPACES, " "))


def html_labels(html: Column, pattern: str) -> Column:
    """Distinct captures of a pattern, resolved and collapsed, in order."""
    return F.array_distinct(F.transform(F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(pattern), 1), lambda x: F.trim(F.regexp_replace(unescape(x), SPACES, " "))))


def canonical_url(url: Column, rewrites: Sequence[tuple[str, str]] = (("http://", "https://"),)) -> Column:
    """Prefixes rewritten, without a trailing slash."""
    out = url
    for old, new in rewrites:
        out = F.when(F.startswith(url, F.lit(old)), F.concat(F.lit(new), F.substring(url, F.lit(len(old) + 1), F.length(url)))).otherwise(out)
    return out


def domain_matches(url: Column, domains: Sequence[str]) -> Column:
    """Any of the substrings; an empty list matches all."""
    return F.lit(True) if not domains else reduce(lambda a, b: a | b, [F.contains(url, F.lit(d)) for d in domains])


def unique_marker(found: Column) -> Column:
    """The marker if there is exactly one distinct, else null."""
    return let(F.array_distinct(found), lambda x: F.when(F.size(x) == 1, F.get(x, F.lit(0))))


#: Fixed values of T29: the forms in which a marker ends a line; {m} is the marker, {label} a collection's label.
MARKER_FORMS = (
    r"\s*[#＃]\s*{m}\s*$",
    r"\s*[—-]?\s*[(\[]\s*{m}\s*[)\]]\s*$",
    r"\s*(?:{label})\s*[:：-]\s*{m}\s*$",
    r"\s*[(\[]\s*{m}\s+(?:{label})\s*[)\]]\s*$",
)


def embedded_marker(text: Column, markers: Sequence[str], forms: Sequence[str] = MARKER_FORMS, labels: Sequence[str] = ("collection", "book")) -> Column:
    """struct(line, marker, start, length, text) if exactly one (line, marker, form) matches at a line's end, else null.

    Text may stand before a marker; ``text`` is the matched span, ``start`` (from
    0) and ``length`` its place in the line. A line is looked at by the forms
    only if it contains some marker, which one pass of alternatives tells.
    """
    import re

    none = F.array().cast("array<struct<line: int, marker: string, start: int, length: int, text: string>>")
    label = "|".join(map(re.escape, labels))
    some = "|".join(map(re.escape, sorted(markers, key=len, reverse=True)))

    def hit(line: Column, i: Column, marker: str, form: str) -> Column:
        span = F.regexp_extract(line, "(?U)" + form.format(m=re.escape(marker), label=label), 0)
        start = F.length(line) - F.length(span)
        return F.when(span != "", F.struct(i.alias("line"), F.lit(marker).alias("marker"), start.alias("start"), F.length(span).alias("length"), span.alias("text")))

    def hits(line: Column, i: Column) -> Column:
        each = F.array_compact(F.array(*[hit(line, i, m, f) for m in markers for f in forms]))
        return F.when(line.rlike(some), each).otherwise(none)

    return let(F.flatten(F.transform(lines(text), hits)), lambda x: F.when(F.size(x) == 1, F.get(x, F.lit(0))))


def without_span(text: Column, marker: Column) -> Column:
    """The text without a marker's span, and without its line if nothing else is in it; null leaves the text as it is."""
    cut = lambda x: F.rtrim(F.substring(x, F.lit(1), marker["start"]))
    kept = F.transform(lines(text), lambda x, i: F.when(i == marker["line"], F.when(cut(x) != "", cut(x))).otherwise(x))
    return F.when(marker.isNull(), text).otherwise(F.array_join(F.filter(kept, lambda x: x.isNotNull()), "\n"))


def has_reference(text: Column, pattern: str) -> Column:
    """Some line, trimmed, matches."""
    return F.exists(lines(text), lambda x: F.trim(x).rlike(pattern))


def without_references(text: Column, pattern: str) -> Column:
    """T31."""
    return F.array_join(F.filter(lines(text), lambda x: ~F.trim(x).rlike(pattern)), "\n")


def nonblank_lines(text: Column) -> Column:
    return F.filter(F.transform(lines(text), lambda x: F.trim(x)), lambda x: x != "")


def zones(text: Column, edge: int = 4) -> Column:
    """struct(header, body, footer): first and last lines, and the rest if there are more than both."""

    def cut(x: Column) -> Column:
        n = F.size(x)
        body = F.when(n > 2 * edge, F.slice(x, F.lit(edge + 1), F.greatest(n - 2 * edge, F.lit(0)))).otherwise(x)
        tail = F.slice(x, F.greatest(n - edge + 1, F.lit(1)), F.lit(edge))
        return F.struct(F.array_join(F.slice(x, 1, edge), "\n").alias("header_text"), F.array_join(body, "\n").alias("body_text"), F.array_join(tail, "\n").alias("footer_text"))

    return let(nonblank_lines(text), cut)


def structural_features(text: Column, letters: str = r"ঀ-৿", digits: str = BANGLA_DIGITS + ASCII_DIGITS, page_chars: int = 2200) -> dict[str, Column]:
    """Counts of lines and characters, by name."""
    x, t = nonblank_lines(text), F.coalesce(text, F.lit(""))
    long = lambda low, high: F.size(F.filter(x, lambda s: F.length(s).between(low, high))).cast("long")
    chars = F.length(F.regexp_replace(t, f"{WS}+", ""))
    return {
        "line_count": F.size(x).cast("long"),
        "char_count": chars.cast("long"),
        "letter_count": F.regexp_count(t, F.lit(f"[{letters}]")).cast("long"),
        "digit_count": F.regexp_count(t, F.lit(f"[{digits}]")).cast("long"),
        "long_line_count": long(30, 1 << 30),
        "short_line_count": long(1, 16),
        "centeredish_line_count": long(1, 24),
        "blank_ratio_estimate": F.lit(1.0) - F.least(chars / F.lit(float(page_chars)), F.lit(1.0)),
    }


def page_candidates(text: Column, edge: int = 4) -> Column:
    """struct(value, zone, line_index, raw) of digit-only lines of 1 to 3 digits in the top and bottom lines.

    Of equal (value, zone) the last stands at the first one's place.
    """
    digits = f"^[^\\p{{L}}\\p{{M}}\\p{{N}}]*([{BANGLA_DIGITS}0-9]{{1,3}})[^\\p{{L}}\\p{{M}}\\p{{N}}]*$"

    def find(x: Column) -> Column:
        n = F.size(x)
        row = lambda s, i, zone: F.struct(from_bangla_digits(F.regexp_extract(s, digits, 1)).alias("value"), F.lit(zone).alias("zone"), i.alias("line_index"), s.alias("raw"))
        top = F.transform(F.slice(x, 1, edge), lambda s, i: row(s, i, "top"))
        start = F.greatest(n - edge, F.lit(0))
        bottom = F.transform(F.slice(x, start + 1, edge), lambda s, i: row(s, i + start, "bottom"))
        return F.filter(F.concat(top, bottom), lambda s: s["value"].isNotNull())

    def last_wins(c: Column) -> Column:
        same = lambda a, b: (a["value"] == b["value"]) & (a["zone"] == b["zone"])
        first = F.filter(c, lambda s, i: ~F.exists(F.slice(c, F.lit(1), i), lambda e: same(e, s)))
        return F.transform(first, lambda s: F.element_at(F.filter(c, lambda e: same(e, s)), -1))

    return let(let(nonblank_lines(text), find), last_wins)


def layout_candidates(candidates: Column) -> Column:
    """Of struct(value, script, y_center, avg_conf, ...) those at the top and bottom, with their zone; by script, zone and confidence."""
    zoned = F.transform(candidates, lambda c: F.struct(F.when(c["script"] == "bangla", 0).otherwise(1).alias("o1"), F.when(c["y_center"] < 0.22, 0).when(c["y_center"] > 0.78, 1).alias("o2"), (-c["avg_conf"]).alias("o3"), c.alias("c")))
    ordered = F.array_sort(F.filter(zoned, lambda z: z["o2"].isNotNull()))
    return F.transform(ordered, lambda z: F.struct(z["c"]["value"].alias("value"), F.when(z["o2"] == 0, "top").otherwise("bottom").alias("zone"), z["c"]["script"].alias("script"), z["c"]["avg_conf"].alias("avg_conf")))


def footer_has_page(footer: Column, expected: Column, extra_digit: bool = False) -> Column:
    """A line of digits and signs alone equals the page, or has one more digit behind it."""
    plain = lambda s: F.translate(F.regexp_replace(s, f"[^{BANGLA_DIGITS}0-9]", ""), BANGLA_DIGITS, ASCII_DIGITS)
    bare = lambda s: s.rlike(r"[\p{N}]") & ~s.rlike(r"[\p{L}]")
    want = expected.cast("string")
    hit = lambda s: bare(s) & ((plain(s) == want) | (F.lit(extra_digit) & F.startswith(plain(s), want) & (F.length(plain(s)) == F.length(want) + 1)))
    return F.exists(lines(footer), hit)


#: Words of dates for the driver's languages, as patterns.
LATIN_MONTHS = r"\b(january|february|march|april|may|june|july|august|september|october|november|december)\b"
LATIN_YEAR = r"\b(1[89]|20)[0-9]{2}\b"
LATIN_PLACES = r"\b(city|village|town|calcutta|london|paris)\b"


def date_evidence(line: Column, months: str = LATIN_MONTHS, year: str = LATIN_YEAR, places: str = LATIN_PLACES) -> Column:
    """Tags of what a line has: month, digit, year, place."""
    t = F.lower(F.coalesce(line, F.lit("")))
    tags = [("month", months), ("digit", f"[{BANGLA_DIGITS}0-9]"), ("year", year), ("place", places)]
    return F.array_compact(F.array(*[F.when(t.rlike(p), F.lit(n)) for n, p in tags]))


def is_date_line(line: Column) -> Column:
    """(month and digit) or (year and place), in 4 to 48 compact characters."""
    size = F.length(F.regexp_replace(F.coalesce(line, F.lit("")), f"{WS}+", ""))
    return size.between(4, 48) & let(date_evidence(line), lambda e: (F.array_contains(e, "month") & F.array_contains(e, "digit")) | (F.array_contains(e, "year") & F.array_contains(e, "place")))


def title_date_parts(title: Column, pattern: str = LATIN_YEAR) -> Column:
    """T38."""
    return F.regexp_extract_all(F.coalesce(title, F.lit("")), F.lit(f"({pattern})"), 1)


def toc_entries(line: Column) -> Column:
    """struct(title, page): the text before each page number is that page's title."""
    number = f"[{BANGLA_DIGITS}0-9]+"
    titles, pages = F.split(line, number), F.regexp_extract_all(line, F.lit(number), 0)
    pair = F.zip_with(F.slice(titles, F.lit(1), F.size(pages)), pages, lambda t, p: F.struct(toc_title(t).alias("title"), page_number(p).alias("page")))
    return F.filter(pair, lambda e: (e["title"] != "") & e["page"].isNotNull())


def line_issues(line: Column) -> Column:
    """What is odd about a line; some kinds exclude others."""
    t = F.trim(F.coalesce(line, F.lit("")))
    digits = f"[{BANGLA_DIGITS}0-9]"
    section = t.rlike(f"^{digits}+$")
    kinds = [
        (t.rlike("[A-Za-z0-9]"), "western_alnum"),
        (t.rlike("[�□■▪]"), "replacement_char"),
        (section, "section_digit_line"),
        (~section & t.rlike(digits), "inline_digit"),
        (t.rlike("^-{5,}$"), "dash_divider"),
        (t.rlike(r"^-(?!-)\s*\S"), "single_leading_dash"),
        (~t.rlike("^-{5,}$") & t.rlike(r"^--+\S"), "multi_leading_dash"),
        (t.rlike(r"^—\s*\S"), "leading_em_dash"),
    ]
    return F.array_compact(F.array(*[F.when(c, F.lit(n)) for c, n in kinds]))


def token_f1(a: Column, b: Column) -> Column:
    """F1 of two distinct token lists; 0 if either is empty."""
    common = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) > 0) & (F.size(b) > 0), 2.0 * common / (F.size(a) + F.size(b))).otherwise(0.0)


def containment_score(a: Column, b: Column, least: int = 5, ratio: float = 0.72) -> Column:
    """0.90 + 0.10 of the length ratio if one text holds the other, is long enough and similar in length."""
    share = F.least(F.length(a), F.length(b)) / F.greatest(F.length(a), F.length(b), F.lit(1))
    holds = F.contains(a, b) | F.contains(b, a)
    return F.when(holds & (F.least(F.length(a), F.length(b)) >= least) & (share >= ratio), 0.90 + 0.10 * share).otherwise(0.0)


def feature_hash(feature: Column, dims: int = 32768) -> Column:
    """CRC-32 of the UTF-8 bytes modulo ``dims``."""
    return F.crc32(F.encode(feature, "UTF-8")) % dims


def sparse_features(text: Column, signature: Column, sizes: Sequence[int] = (3, 5, 8), exact: float = 1.0, by_class: float = 0.5) -> Column:
    """struct(feature, weight) of distinct n-grams of a compact text and of its signature; a size's weight is n / min(sizes)."""

    def part(n: int, kind: str, column: Column, base: float) -> Column:
        row = lambda g: F.struct(F.concat(F.lit(f"{kind}:{n}:"), g).alias("feature"), F.lit(base * n / min(sizes)).alias("weight"))
        return F.transform(char_ngram_set(column, n), row)

    return F.concat(*(part(n, kind, column, base) for n in sizes for kind, column, base in (("exact", text, exact), ("class", signature, by_class))))


def sigmoid(x: Column) -> Column:
    """T49."""
    return 1.0 / (1.0 + F.exp(-x))


def page_label(label: Column, start: Column, end: Column) -> Column:
    """The given label, or ``a``, or ``a-b``."""
    span = F.when(end.isNull() | (end == start), start.cast("string")).otherwise(F.concat_ws("-", start.cast("string"), end.cast("string")))
    return F.coalesce(F.when(label != "", label), span)


def interpolate(template: Column, values: dict[str, Column]) -> Column:
    """``{key}`` becomes the key's value."""
    return reduce(lambda t, kv: F.replace(t, F.lit("{%s}" % kv[0]), kv[1].cast("string")), values.items(), template)


def import_normalize(text: Column) -> Column:
    """Bengali digits, line ends, byte order marks, trimmed."""
    t = F.translate(F.coalesce(text, F.lit("")), BANGLA_DIGITS, ASCII_DIGITS)
    return F.trim(F.regexp_replace(F.replace(F.replace(t, F.lit("\r\n"), F.lit("\n")), F.lit("﻿"), F.lit("")), r"^\s+|\s+$", ""))


def fold_letters(text: Column) -> Column:
    """Letters with a nukta become plain ones (the decomposed forms; see kernels.nfc_fold for full NFC)."""
    pairs = (("ড়", "ড"), ("ঢ়", "ঢ"), ("য়", "য"), ("়", ""))
    return replace_all(text, pairs)


def title_key(title: Column, corrections: dict[str, str] | None = None) -> Column:
    """Without a bracketed hint at the end and punctuation; corrections of known titles apply last."""
    t = F.regexp_replace(F.coalesce(title, F.lit("")), r"\s*[\(\[][^\)\]]*[\)\]]\s*$", "")
    t = collapse(F.regexp_replace(F.lower(t), r"[^\p{L}\p{M}\p{N}\s]+", " "))
    if not corrections:
        return t
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in corrections.items() for x in kv]), t), t)


def body_key(text: Column) -> Column:
    """Folded, and letters, marks and numbers only."""
    return F.regexp_replace(fold_letters(F.lower(F.coalesce(text, F.lit("")))), r"[^\p{L}\p{M}\p{N}]+", "")


def is_url(text: Column) -> Column:
    """An absolute URL that parses."""
    return F.coalesce(F.try_parse_url(text, F.lit("HOST")).isNotNull() & F.try_parse_url(text, F.lit("PROTOCOL")).isin("http", "https"), F.lit(False))


def numbered_id(prefix: Column, number: Column) -> Column:
    """Prefix-001."""
    return F.concat(prefix, F.lit("-"), F.lpad(number.cast("string"), 3, "0"))


def stanzas(text: Column) -> Column:
    """Lists of trimmed non-empty lines, split at blank lines."""
    groups = F.split(F.regexp_replace(F.coalesce(text, F.lit("")), r"\n[ \t]+\n", "\n\n"), "\n{2,}")
    cut = F.transform(groups, lambda g: F.filter(F.transform(F.split(g, "\n"), lambda x: F.trim(x)), lambda x: x != ""))
    return F.filter(cut, lambda g: F.size(g) > 0)


def first_lines(text: Column, n: int) -> Column:
    """The first lines of the stanzas."""
    return F.slice(F.flatten(stanzas(text)), 1, n)


def long_lines(text: Column, least: int, profile: NormProfile = LATIN) -> Column:
    """struct(line_index, text) of normalised lines of enough compact characters; original indexes."""
    numbered = F.transform(lines(text), lambda x, i: F.struct(i.alias("line_index"), normalize(x, profile).alias("text")))
    return F.filter(numbered, lambda s: F.length(F.replace(s["text"], F.lit(" "), F.lit(""))) >= least)


def merged_lines(streams: Sequence[Column], profile: NormProfile = LATIN) -> Column:
    """Normalised non-empty lines of several streams, one after the other."""
    every = F.concat(*(lines(s) for s in streams))
    return F.filter(F.transform(every, lambda x: normalize(x, profile)), lambda x: x != "")


def region_lines(text: Column, most: int = 520, profile: NormProfile = LATIN) -> Column:
    """struct(line_index, text) of lines of 3 to ``most`` compact characters that aren't digits; first of equal ones."""
    numbered = F.transform(lines(text), lambda x, i: F.struct(i.alias("line_index"), normalize(x, profile).alias("text")))
    size = lambda s: F.length(F.replace(s["text"], F.lit(" "), F.lit("")))
    kept = F.filter(numbered, lambda s: size(s).between(3, most) & ~s["text"].rlike("^[0-9 ]+$"))
    return let(kept, lambda k: F.filter(k, lambda s, i: ~F.exists(F.slice(k, F.lit(1), i), lambda e: e["text"] == s["text"])))


def letter_count(text: Column, letters: str = r"ঀ-৿") -> Column:
    """T63."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(f"[{letters}]"))


def tag_rules(text: Column, rules: Sequence[tuple[str, str]], first: Column | None = None, most: int = 3, default: str = "other") -> Column:
    """The given tag, then tags whose pattern matches, in order, at most ``most``; else the default."""
    head = [first] if first is not None else []
    found = F.array_distinct(F.array_compact(F.array(*head, *[F.when(text.rlike(p), F.lit(t)) for p, t in rules])))
    return let(found, lambda x: F.when(F.size(x) > 0, F.slice(x, 1, most)).otherwise(F.array(F.lit(default))))


def sample_evenly(items: Column, most: int) -> Column:
    """At most so many items, evenly spaced, by half-even rounded index."""
    step = lambda x: (F.size(x) - 1) / F.lit(float(max(1, most - 1)))
    pick = lambda x: F.transform(F.array_distinct(F.transform(F.sequence(F.lit(0), F.lit(most - 1)), lambda i: F.bround(i * step(x), 0).cast("int"))), lambda i: F.get(x, i))
    return F.when(F.size(items) <= most, items).otherwise(let(items, pick))
