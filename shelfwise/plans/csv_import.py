"""Validated CSV import: rules, batch gate, prices, actions, image presence."""

from __future__ import annotations

from pyspark.sql import DataFrame

from shelfwise import constants as K
from shelfwise.operators import importing as M


def plan(raw: DataFrame, store: DataFrame, rate: DataFrame, files: DataFrame, prefix: str = K.SKU_PREFIX) -> dict[str, DataFrame]:
    accepted, errors = M.batch_gate(M.validate_rows(raw, prefix))
    priced = M.price_rows(accepted, rate)
    return {"rows": M.upsert_actions(priced, store), "images": M.image_presence(accepted, files), "errors": errors}
