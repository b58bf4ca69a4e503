"""Rule data of the page checks.  Users swap any of it through ``CheckRules``.

Brand words belong to a site, so they have no built-in value beyond a stand-in.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

# Regular expressions of placeholder text.
PLACEHOLDERS = (r"\bTODO\b", r"\bFIXME\b", r"\[PLACEHOLDER\]", r"Lorem ipsum", r"\[INSERT\b")

# Action verbs looked for in a title.
TITLE_VERBS = tuple(
    """convert create merge split extract edit add remove insert format compress encrypt sign
    watermark annotate render parse generate export import read write load save open close
    resize rotate scan recognize""".split()
)

# Action verbs looked for in a description.
DESCRIPTION_VERBS = tuple(
    """learn discover convert create merge split edit manage generate extract process automate
    optimize explore master implement build add remove read write parse render export import""".split()
)

# Format and language words looked for in a description.
FORMAT_WORDS = tuple("pdf word excel powerpoint cells slides email html cad ocr barcode".split())
LANGUAGE_WORDS = (r"\.net", "java", "python", "c#")

# Action and format words looked for in tags.
TAG_WORDS = tuple(
    """convert merge split edit create parse render export import compress pdf word excel html
    image barcode ocr email slide cell""".split()
)

# Shortcodes of the page layout.
WRAPPER_OPEN = r"\{\{<\s*blocks/products/pf/main-wrap-class\s*>\}\}"
WRAPPER_CLOSE = r"\{\{<\s*/blocks/products/pf/main-wrap-class\s*>\}\}"
BACK_TO_TOP = r"\{\{<\s*blocks/products/products-backtop-button\s*>\}\}"
RELREF = r"\{\{<\s*relref\s+"

# Tags that must be closed.
CLOSED_TAGS = ("xref", "pre", "code")


@dataclass(frozen=True)
class CheckRules:
    """Word lists, limits and variants of the page checks."""

    brands: tuple[str, ...] = ("acme",)
    placeholders: tuple[str, ...] = PLACEHOLDERS
    title_verbs: tuple[str, ...] = TITLE_VERBS
    description_verbs: tuple[str, ...] = DESCRIPTION_VERBS
    format_words: tuple[str, ...] = FORMAT_WORDS
    language_words: tuple[str, ...] = LANGUAGE_WORDS
    tag_words: tuple[str, ...] = TAG_WORDS
    wrapper_open: str = WRAPPER_OPEN
    wrapper_close: str = WRAPPER_CLOSE
    back_to_top: str = BACK_TO_TOP
    relref: str = RELREF
    closed_tags: tuple[str, ...] = CLOSED_TAGS
    min_description: int = 50
    max_description: int = 160
    min_seo_title: int = 30
    max_seo_title: int = 60
    min_body: int = 100
    min_words: int = 200
    translated_share: float = 0.05
    word_repeats: int = 2
    min_tags: int = 3
    max_tags: int = 10
    tables_per_block: bool = False
    user_checks: tuple[tuple[str, Callable], ...] = ()
