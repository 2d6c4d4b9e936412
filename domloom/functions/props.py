"""Node properties as Columns over the node table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from domloom.schema import COMMENT, DOCUMENT, ELEMENT, TEXT

HTML_SPACE = " \t\n\f\r"


def is_element() -> Column:
    return F.col("kind") == ELEMENT


def is_text() -> Column:
    return F.col("kind") == TEXT


def is_comment() -> Column:
    return F.col("kind") == COMMENT


def is_document() -> Column:
    return F.col("kind") == DOCUMENT


def is_empty_text_node() -> Column:
    """Text with nothing but ASCII white space (no text at all counts); false for other kinds."""
    return is_text() & ~F.coalesce(F.col("data"), F.lit("")).rlike(r"[^ \t\n\f\r]")


def tag_id(tag: Column | None = None) -> Column:
    """Integer code of a tag name: the first 60 bits of its MD5.

    A pure function of the name, so codes agree between runs and tables and need no dictionary join.
    """
    return F.conv(F.substring(F.md5(F.col("tag") if tag is None else tag), 1, 15), 16, 10).cast("long")


def attr(name: str) -> Column:
    """Attribute value; NULL when absent, when written without a value, or on non-elements."""
    return F.get(F.filter("attrs", lambda a: a["name"] == name), F.lit(0))["value"]


def has_attr(name: str) -> Column:
    return attr(name).isNotNull()


def attributes() -> Column:
    """All attributes as a map."""
    return F.map_from_entries("attrs")


def classes(class_attr: Column | None = None) -> Column:
    """Class names in source order, duplicates kept."""
    value = attr("class") if class_attr is None else class_attr
    return F.filter(F.split(F.coalesce(value, F.lit("")), r"[ \t\n\f\r]+"), lambda c: c != "")


def has_word(value: Column, word: str) -> Column:
    """``word`` is one of the white-space separated words of ``value`` (case-sensitive)."""
    if not word or any(c in HTML_SPACE for c in word):
        return F.lit(False)
    padded = F.concat(F.lit(" "), F.translate(value, "\t\n\f\r", "    "), F.lit(" "))
    return F.coalesce(padded.contains(f" {word} "), F.lit(False))


def has_class(name: str, class_attr: Column | None = None) -> Column:
    return has_word(attr("class") if class_attr is None else class_attr, name)


def text_content() -> Column:
    """Own data of text and comment nodes, NULL otherwise."""
    return F.when(is_text() | is_comment(), F.col("data"))


def comment_content() -> Column:
    return F.when(is_comment(), F.col("data"))


def raw_value() -> Column:
    """UTF-8 bytes of a text node, NULL otherwise."""
    return F.when(is_text(), F.encode("data", "UTF-8"))


def attr_rows(nodes: DataFrame) -> DataFrame:
    """One row per attribute: ``(page_id, pre, tag, pos, name, value)``."""
    return nodes.select("page_id", "pre", "tag", F.posexplode("attrs").alias("pos", "a")).select(
        "page_id", "pre", "tag", "pos", "a.name", "a.value"
    )


def tag_dictionary(nodes: DataFrame) -> DataFrame:
    """Tags in use with their codes (partial aggregation before the shuffle)."""
    return nodes.filter(is_element()).select("tag").distinct().select("tag", tag_id().alias("tag_id"))


def resolve_tag_ids(nodes: DataFrame, names: DataFrame, name: str = "name") -> DataFrame:
    """``names`` with ``tag_id``: the code when some node carries the tag, NULL otherwise."""
    return names.join(tag_dictionary(nodes).withColumnRenamed("tag", name), name, "left")
