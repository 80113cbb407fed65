"""Nearest neighbours by inner product: a block matrix join over int8 tiles.

Vectors are quantised to int8 with a scale each. The product of two quantised blocks gives all
inner products of a tile within an error bound that the norms of vectors and of what quantising
lost prove. Only pairs that may belong to a query's k best are computed from the original vectors,
in double precision, and the tiles' lists are merged by heaps. Nothing is lost: recall is 1.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import tiles

CHUNK = 1024  # dimensions whose int8 products add up exactly in single precision


def _useful(v: Column) -> Column:
    return tiles.finite(v) & F.exists(v, lambda x: x != 0)


def _packed(ids: np.ndarray, v: np.ndarray) -> dict[str, bytes]:
    wide = v.astype(np.float64)
    with np.errstate(over="ignore"):
        scale = np.abs(wide).max(1) / 127
        scale[scale == 0] = np.finfo(np.float64).tiny
        small = np.clip(np.rint(wide / scale[:, None]), -127, 127)
        kept = small * scale[:, None]
        norms = np.stack([scale, *(np.sqrt((x * x).sum(1)) for x in (wide, kept, wide - kept))])
    return {"ids": ids.astype("<i8").tobytes(), "small": small.astype(np.int8).tobytes(),
            "norms": norms.astype("<f8").tobytes(), "original": v.astype("<f8").tobytes()}


_SHAPE = "ids binary, small binary, norms binary, original binary"


def _prepared(line: dict, side: str) -> dict:
    dim, ids = line[f"{side}dim"], np.frombuffer(line[f"{side}ids"], "<i8")
    scale, whole, kept, lost = np.frombuffer(line[f"{side}norms"], "<f8").reshape(4, -1)
    return {"ids": ids, "small": np.frombuffer(line[f"{side}small"], np.int8).reshape(-1, dim).astype(np.float32),
            "scale": scale, "whole": whole, "kept": kept, "lost": lost,
            "original": np.frombuffer(line[f"{side}original"], "<f8").reshape(-1, dim)}


def _tile(q: dict, c: dict, best: tiles.Best) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    product = np.zeros((len(q["ids"]), len(c["ids"])))
    for at in range(0, q["small"].shape[1], CHUNK):
        product += q["small"][:, at:at + CHUNK] @ c["small"][:, at:at + CHUNK].T
    with np.errstate(over="ignore", invalid="ignore"):
        product *= q["scale"][:, None] * c["scale"]
        # <q, c> - <q', c'> = <q - q', c> + <q', c - c'>, and a little for rounding.
        error = (q["lost"][:, None] * c["whole"] + q["kept"][:, None] * c["lost"]
                 + 1e-12 * q["whole"][:, None] * c["whole"])
        low, high = product - error, product + error
    low[np.isnan(low)], high[np.isnan(high)] = -np.inf, np.inf
    own = q["ids"][:, None] == c["ids"]
    low[own] = -np.inf
    row, column = np.nonzero(tiles.survivors(low, high, best) & ~own)
    with np.errstate(over="ignore", invalid="ignore"):
        score = np.concatenate([np.zeros(0), *(
            tiles.sequential(q["original"][row[i:i + 65536]], c["original"][column[i:i + 65536]])
            for i in range(0, len(row), 65536))])
    # Products beyond the range of doubles may have no sum; such pairs come last.
    return row, column, np.where(np.isnan(score), -np.inf, score)


def nearest(df: DataFrame, is_query: Column, k: int = 20, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: of each query the k other rows of largest inner
    product, ties to the smaller id; all of them if there are fewer.

    `is_query` is a condition on `id`. Vectors that are null, empty, zero or hold null or non-finite
    components take no part, nor do rows without an id; of rows that repeat an id the smallest
    vector counts. Vectors meet those of their own dimension only. No vectors, no rows; a vector is one
    value, however long. A sum that overflows to both sides has no value and counts as minus infinity.
    Other columns are not read.
    """
    vectors = tiles.one_row_an_id(df, key, vector, _useful)
    candidates, _ = tiles.blocks(vectors, tiles.CANDIDATES, _packed, _SHAPE, "candidates")
    queries, _ = tiles.blocks(vectors.where(is_query), tiles.QUERIES, _packed, _SHAPE, "queries")
    return tiles.search(tiles.grid(queries, candidates), k, "double", _prepared, _tile)
