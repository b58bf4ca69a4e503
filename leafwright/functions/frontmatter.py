"""Frontmatter: the ``---`` block in front of a page."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafwright.functions.text import pattern

_HEAD = pattern(r"^---\s*\n(.*?)\n---\s*\n?", "s")

YAML_TYPE = "valid boolean, is_map boolean, tags_kind string, tags array<string>, tags_all_text boolean"


def split_frontmatter(content: Column) -> tuple[Column, Column]:
    """``(fm, body)`` of a page; ``fm`` is NULL when there is no block.

    The wide text is matched once, for the block only; the body is what follows.
    """
    head = F.regexp_extract(content, _HEAD, 0)
    fm = F.when(head != "", F.regexp_extract(head, _HEAD, 1))
    body = F.substr(content, F.length(head) + 1)
    return fm, body


def with_frontmatter(df: DataFrame, content: str = "content") -> DataFrame:
    """Add the columns ``fm`` and ``body``."""
    with_head = df.withColumn("_head", F.regexp_extract(content, _HEAD, 0))
    return with_head.select(
        *df.columns,
        F.when(F.col("_head") != "", F.regexp_extract("_head", _HEAD, 1)).alias("fm"),
        F.substr(F.col(content), F.length("_head") + 1).alias("body"),
    )


def field_pattern(key: str, value: str = r"\s*(.+)") -> str:
    """Pattern of one ``key: value`` line.

    The blanks after the colon may run over a line end, so an empty value takes
    the next line.
    """
    return pattern(rf"^\s*{key}\s*:{value}", "m")


def fm_field(fm: Column, key: str) -> Column:
    """Value of a frontmatter key, NULL when the key is not there."""
    found = F.regexp_extract(fm, field_pattern(key), 1)
    return F.when(found != "", found)


def fm_has(fm: Column, key: str, value: str = r"\s*.+") -> Column:
    """True when a frontmatter key is there (with some text by default)."""
    return F.coalesce(fm.rlike(field_pattern(key, value)), F.lit(False))


def parse_yaml(fm: Column) -> Column:
    """Read frontmatter as YAML: is it valid, is it a map, and its tags.

    Equal blocks in one Arrow batch are read once.  The function is nested, so
    that it travels to executors that do not have this package.
    """

    def read_blocks(blocks: pd.Series) -> pd.DataFrame:
        import yaml

        cols = ["valid", "is_map", "tags_kind", "tags", "tags_all_text"]

        # The C parser gives the same data several times faster, where it is built in.
        loader = getattr(yaml, "CSafeLoader", yaml.SafeLoader)

        def read(text: str) -> tuple:
            try:
                data = yaml.load(text, Loader=loader)
            except (yaml.YAMLError, ValueError):
                return False, False, None, None, None
            if not isinstance(data, dict):
                return True, False, None, None, None
            tags = data.get("tags")
            if tags is None:
                return True, True, None, None, None
            if not isinstance(tags, list):
                return True, True, "other", None, None
            return True, True, "list", [str(t) for t in tags], all(isinstance(t, str) for t in tags)

        known = {text: read(text) for text in blocks.dropna().unique()}
        none = (None,) * len(cols)
        return pd.DataFrame([known.get(text, none) for text in blocks], columns=cols)

    return F.pandas_udf(read_blocks, YAML_TYPE)(fm)
