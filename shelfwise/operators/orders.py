"""New orders: filter, cursor, item summary and alert text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfwise import constants as K
from shelfwise.functions import text as T
from shelfwise.operators.keys import top_per_group

# Words of the alert text
_LINE = "• "
_NO_ITEMS = "• (فاقد جزئیات اقلام)"
NAME_LENGTH = 40


def watched(orders: DataFrame, statuses=K.WATCHED_STATUSES) -> DataFrame:
    return orders.filter(F.col("status").isin(*statuses))


def new_orders(
    orders: DataFrame,
    last_seen: int | Column,
    poll_limit: int | None = None,
    lookback: int | None = None,
    statuses=K.WATCHED_STATUSES,
) -> DataFrame:
    """Watched orders above the cursor.

    ``poll_limit`` looks at the newest so many orders only (what arrives beyond that between two polls is lost), and
    ``lookback`` bounds a first run; both are off unless asked for, and both cuts are distributed top-k.
    """
    latest = watched(orders, statuses)
    if poll_limit is not None:
        latest = latest.orderBy(F.desc("id")).limit(poll_limit)
    latest = latest.filter(F.col("id") > last_seen)
    if lookback and isinstance(last_seen, int) and last_seen <= 0:
        latest = latest.orderBy(F.desc("id")).limit(lookback)
    return latest


def next_cursor(orders: DataFrame, last_seen: int) -> DataFrame:
    return orders.agg(F.greatest(F.coalesce(F.max("id"), F.lit(last_seen)), F.lit(last_seen)).alias("last_seen_id"))


def item_summary(items: DataFrame, shown: int = 3, names: DataFrame | None = None) -> DataFrame:
    """(id, first_items, item_count). Only ``shown`` lines per order are gathered, however many an order has.

    ``items``: id, position, quantity, name; or ``item`` in place of the name, which ``names`` (item, name) then
    resolves for the lines shown alone.
    """
    counts = items.groupBy("id").agg(F.count(F.lit(1)).alias("item_count"))
    top = top_per_group(items, ["id"], [F.asc("position")], shown)
    if names is not None:
        top = top.join(names, "item", "left")
    first = top.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("rank", "name", "quantity"))).alias("lines"))
    return counts.join(first, "id").select(
        "id",
        "item_count",
        F.transform("lines", lambda x: F.struct(x["name"].alias("name"), x["quantity"].alias("quantity"))).alias("first_items"),
    )


def with_items(orders: DataFrame, items: DataFrame, shown: int = 3, names: DataFrame | None = None) -> DataFrame:
    """Embedded items win; otherwise the order's lines are looked up. Both sides hold one row per order id."""
    joined = orders.join(item_summary(items, shown, names), "id", "left")
    has = F.col("line_items").isNotNull()
    return (
        joined.withColumn("item_count", F.when(has, F.size("line_items").cast("bigint")).otherwise(F.coalesce("item_count", F.lit(0))))
        .withColumn(
            "first_items",
            F.when(has, F.slice("line_items", 1, shown)).otherwise(
                F.coalesce("first_items", F.array().cast("array<struct<name:string,quantity:int>>"))
            ),
        )
        .drop("line_items")
    )


def city(shipping_city: Column, billing_city: Column, shipping: Column | None = None, billing: Column | None = None) -> Column:
    """Flat fields first, then the nested ones, then a dash."""
    values = [shipping_city, billing_city]
    if shipping is not None:
        values.append(shipping["city"])
    if billing is not None:
        values.append(billing["city"])
    return F.coalesce(*[F.nullif(v, F.lit("")) for v in values], F.lit("—"))


def alert_text(
    order_id: Column, status: Column, place: Column, first_items: Column, item_count: Column, total: Column, currency: Column, name_length: int = NAME_LENGTH
) -> Column:
    """Owner alert: id, status, city, up to three items (names cut to ``name_length`` characters), total."""
    status_text = F.lit(None)
    for code, words in K.STATUS_TEXT:
        status_text = F.coalesce(status_text, F.when(status == code, words))
    status_text = F.coalesce(status_text, status)
    lines = F.transform(
        first_items,
        lambda item: F.concat(
            F.lit(_LINE),
            T.persian_digits(F.coalesce(item["quantity"], F.lit(1))),
            F.lit("× "),
            F.substring(F.coalesce(item["name"], F.lit("محصول")), 1, name_length),
        ),
    )
    more = F.when(
        item_count > 3, F.concat(F.lit("• و "), T.persian_digits(item_count - 3), F.lit(" قلم دیگر"))
    )
    body = F.when(item_count > 0, F.concat_ws("\n", lines, more)).otherwise(_NO_ITEMS)
    amount = F.replace(total.cast("string"), F.lit(","), F.lit("")).try_cast("double").try_cast("bigint")
    amount_text = F.coalesce(T.toman_text(amount), T.persian_digits(total))
    suffix = F.when((F.coalesce(currency, F.lit("")) != "") & (F.upper(currency) != K.CURRENCY), F.concat(F.lit(" ("), currency, F.lit(")"))).otherwise("")
    return F.concat(
        F.lit("📦 سفارش جدید #"),
        T.persian_digits(order_id),
        F.lit("\nوضعیت: "),
        status_text,
        F.lit("\nشهر: "),
        place,
        F.lit("\n"),
        body,
        F.lit("\nمبلغ: "),
        amount_text,
        F.lit(" تومان"),
        suffix,
    )


def alerts(orders: DataFrame) -> DataFrame:
    """(id, text) of every order that carries ``first_items`` and ``item_count``."""
    place = city(F.col("shipping_city"), F.col("billing_city"))
    text = alert_text(
        F.col("id"), F.col("status"), place, F.col("first_items"), F.col("item_count"), F.col("total"), F.col("currency")
    )
    return orders.select("id", text.alias("text"))
