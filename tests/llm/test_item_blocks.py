"""Benchmark items come to the driver in bounded blocks, however often they repeat."""

from tidemark.llm import fm_index


def test_repeated_items_do_not_fill_a_block(spark):
    rows = [(1, "a copied item " * 3)] * 900 + [(k, f"item number {k} " * 3) for k in range(2, 40)] + [(None, None), (2, None)]
    items = spark.createDataFrame(rows, "item_id bigint, text string")
    blocks = list(fm_index.item_blocks(items, "item_id", "text", 300))
    found = [row for block in blocks for row in block]
    assert len(found) == len(set(found)) == 41 and len(blocks) > 8
    assert max(sum(len(t or "") for _, t in block) for block in blocks) < 900
    assert [row for block in fm_index.item_blocks(items.limit(0), "item_id", "text") for row in block] == []
