"""Comma-joined id lists."""

from pyspark.sql import Column, functions as F

from shoplens.defaults import ID_LIST_SEPARATOR


def id_list(c) -> Column:
    """``"1,1,2"`` -> ``["1", "1", "2"]``; repeated ids stay repeated; null stays null.

    Empty ids are kept at the start and in the middle and dropped at the end, as the
    original jobs' ``split`` does: ``"1,,2,,"`` -> ``["1", "", "2"]``, ``","`` -> ``[]``.
    A text without any separator is one id, also the empty text.
    """
    c = F.col(c) if isinstance(c, str) else c
    stripped = F.rtrim(c, F.lit(ID_LIST_SEPARATOR))
    return (F.when((stripped == "") & (c != ""), F.array().cast("array<string>"))
            .when(c.isNotNull(), F.split(stripped, ID_LIST_SEPARATOR)))
