"""Schemas of the page table and of the node table."""

from pyspark.sql import types as T

ELEMENT, TEXT, COMMENT, DOCUMENT, DOCTYPE = 1, 3, 8, 9, 10

PAGES = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("html", T.StringType()),
    ]
)

ATTR = T.StructType([T.StructField("name", T.StringType()), T.StructField("value", T.StringType())])

# One row per DOM node.  ``pre`` is an order label: unique and increasing in document order within a
# page, dense after shredding, possibly with gaps after edits.  A node's subtree is the rows with
# ``pre`` in ``[node.pre, node.last]``.  ``node_id`` is the label given by the shredder and survives
# every edit; it is NULL for nodes an edit added.
NODES = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("node_id", T.LongType()),
        T.StructField("pre", T.LongType()),
        T.StructField("last", T.LongType()),
        T.StructField("parent", T.LongType()),
        T.StructField("depth", T.IntegerType()),
        T.StructField("kind", T.IntegerType()),
        T.StructField("ns", T.StringType()),
        T.StructField("tag", T.StringType()),
        T.StructField("attrs", T.ArrayType(ATTR)),
        T.StructField("data", T.StringType()),
        T.StructField("in_head", T.BooleanType()),
        T.StructField("in_body", T.BooleanType()),
    ]
)

NODE_COLUMNS = NODES.fieldNames()
# Added by operators.index.with_index.
INDEX_COLUMNS = ["id", "class", "sib_idx", "sib_n", "el_idx", "el_rev", "ty_idx", "ty_rev", "prev_el", "hollow", "verbatim"]
