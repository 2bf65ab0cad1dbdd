"""What an agenda item's text is made of.

An item's document is its transcript portions followed by its attachments. It
is kept as ordered portion rows and never glued together: term counts add up
over portions, and no item has to fit one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TRANSCRIPT, ATTACHMENT = 0, 1


def item_portions(transcript_texts: DataFrame, attachment_texts: DataFrame) -> DataFrame:
    """`(minutes_item_id, kind, uri, text)`; `(kind, uri)` is the reading order."""
    def rows(texts: DataFrame, kind: int) -> DataFrame:
        return texts.select("minutes_item_id", F.lit(kind).alias("kind"), "uri", "text")

    both = rows(transcript_texts, TRANSCRIPT).unionByName(rows(attachment_texts, ATTACHMENT))
    return both.where(F.length("text") > 0)
