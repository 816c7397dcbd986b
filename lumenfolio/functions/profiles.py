"""Normalisation profiles: what a text keeps, and which characters count as equal."""

from __future__ import annotations

from dataclasses import dataclass, field

# Fixed values of the Bengali profiles.
BANGLA_DIGITS = "০১২৩৪৫৬৭৮৯"
ASCII_DIGITS = "0123456789"
ZERO_WIDTH = ("​", "‌", "‍")
BANGLA_KEEP = "ঀ-৿0-9"
MATCH_EQUIVALENCES = (
    ("ি", "ী"),
    ("ু", "ূ"),
    ("ন", "ণ"),
    ("য", "য়", "য়"),
    ("র", "ব"),
    ("দ", "ধ"),
    ("ৎ", "ত"),
)
CORPUS_EQUIVALENCES = (
    ("ি", "ী"),
    ("ু", "ূ"),
    ("ে", "ৈ"),
    ("ো", "ৌ"),
    ("ন", "ণ"),
    ("য", "য়", "য়"),
    ("র", "ব"),
    ("দ", "ধ"),
    ("ৎ", "ত"),
    ("ং", "ঙ"),
)
LEXICON_EQUIVALENCES = (
    ("ি", "ী"),
    ("ু", "ূ"),
    ("ন", "ণ"),
    ("য", "য়", "য়"),
    ("র", "ব"),
    ("দ", "ধ"),
    ("ৎ", "ত"),
    ("ং", "ঙ"),
    ("শ", "ষ", "স"),
    ("ে", "ো"),
    ("া", "ে"),
)
BANGLA_CLASSES = ("ািীুূৃেৈোৌ", "নণংঙঞ", "শষস", "যয়", "রব", "দধ", "তৎ", "চছ", "জঝ")
LOOSE_MARKS = "[ঁংঃািীুূৃেৈোৌ্]"
NOISE_FRAGMENTS = ("ট", "টট", "কক", "গে", "জে", "দে", "মে", "তে", "রে", "সস", "এস")

#: Latin counterparts for the driver's texts.
LATIN_KEEP = r"\p{L}\p{M}\p{N}"
LATIN_EQUIVALENCES = (("o", "0"), ("l", "1"), ("e", "é", "è", "ê"), ("a", "ä", "á"))
LATIN_CLASSES = ("aeiouy", "mn", "sz", "bpdtg", "ckq", "fvw", "lr")


@dataclass(frozen=True)
class NormProfile:
    """How a text is normalised for matching, in this order.

    Zero-width characters go, digits become ASCII, letters become lower case
    (``lower``), runs outside ``keep`` and white space become one space, words
    are substituted, equivalent characters are replaced one pair after the
    other, and white space is collapsed and trimmed.
    """

    keep: str = LATIN_KEEP
    lower: bool = True
    digits: bool = True
    equivalences: tuple[tuple[str, ...], ...] = ()
    substitutions: dict[str, str] = field(default_factory=dict, hash=False)


LATIN = NormProfile()
BANGLA_MATCH = NormProfile(BANGLA_KEEP, lower=False, equivalences=MATCH_EQUIVALENCES)
BANGLA_CORPUS = NormProfile(BANGLA_KEEP, lower=False, equivalences=CORPUS_EQUIVALENCES)
