"""Retail questions over orders, order items, products, categories and suppliers.

Item rows are summed per product or per order before any join. That first sum combines
on the map side, so one product or order holding a third of all items shrinks to a row
per task before it is shuffled. Joins with whole tables carry no broadcast hint: Spark
broadcasts a side only when its size, estimated or measured at run time, is below the
session threshold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyloom.functions.scalars import line_amount, month_of
from tallyloom.operators.joins import sent_if_few

# The labels of the restocking classification.
URGENCY = ("urgent", "monitor", "ok")


def _amount():
    return line_amount(F.col("quantity"), F.col("unit_price"))


def top_selling_products(items: DataFrame, products: DataFrame, categories: DataFrame, n: int = 5) -> DataFrame:
    """The n best (product name, category) by revenue. Products sharing a name and a
    category count as one."""
    sold = items.groupBy("product_id").agg(
        F.sum("quantity").alias("units"), F.sum(_amount()).alias("amount"))
    # Summed once more before the categories join in, since one may hold most products.
    named = (
        sold.join(products.select("product_id", "product_name", "category_id"), "product_id")
        .groupBy("product_name", "category_id")
        .agg(F.sum("units").alias("units"), F.sum("amount").alias("amount")))
    return (
        named.join(categories.select("category_id", "category_name"), "category_id")
        .groupBy("product_name", "category_name")
        .agg(F.sum("units").alias("units_sold"), F.sum("amount").alias("revenue"))
        .orderBy(F.desc("revenue"), "product_name", "category_name")
        .limit(n)
    )


def customer_order_history(orders: DataFrame, items: DataFrame, customer_id) -> DataFrame:
    """The orders of one customer that have items, with item count and total, by date. The
    items are not shuffled before the join unless the customer has very many orders."""
    mine = orders.where(F.col("customer_id") == F.lit(customer_id)).select("order_id", "order_date", "status")
    return (
        items.join(sent_if_few(mine), "order_id")
        .groupBy("order_id", "order_date", "status")
        .agg(F.count("order_item_id").alias("item_count"), F.sum(_amount()).alias("order_total"))
        .orderBy("order_date", "order_id")
    )


def monthly_revenue(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Revenue and number of distinct orders per calendar month, whatever the status."""
    per_order = items.groupBy("order_id").agg(F.sum(_amount()).alias("amount"))
    return (
        orders.select("order_id", month_of(F.col("order_date")).alias("month"))
        .join(per_order, "order_id")
        .groupBy("month")
        .agg(F.sum("amount").alias("revenue"), F.count_distinct("order_id").alias("order_count"))
        .orderBy("month")
    )


def _running_low(products: DataFrame) -> DataFrame:
    return products.where(
        (F.col("quantity_on_hand") <= F.col("reorder_level")) & (F.col("discontinued") == F.lit(False)))


def low_stock_products(products: DataFrame, suppliers: DataFrame) -> DataFrame:
    """Products still sold that are at or below their reorder level, with the supplier."""
    return (
        _running_low(products).join(suppliers.select("supplier_id", "supplier_name"), "supplier_id")
        .select("product_name", "quantity_on_hand", "reorder_level", "supplier_name")
    )


def urgency(on_hand: Column, level: Column) -> Column:
    urgent, monitor, ok = URGENCY
    return F.when(on_hand * 2 <= level, urgent).when(on_hand <= level, monitor).otherwise(ok)


def restock_urgency(products: DataFrame) -> DataFrame:
    """Running-low products labelled by how far below the reorder level they are. This is
    the rule form; ``functions.models.classify`` learns from labelled rows instead."""
    label = urgency(F.col("quantity_on_hand"), F.col("reorder_level"))
    return (
        _running_low(products)
        .select("product_name", "quantity_on_hand", "reorder_level", label.alias("restock_urgency"))
        .orderBy("quantity_on_hand", "product_name", "reorder_level")
    )


def restock_text(products: DataFrame) -> DataFrame:
    """Running-low products with the sentence a text classifier reads."""
    text = F.concat(
        F.lit("Product: "), F.col("product_name"),
        F.lit(", quantity on hand: "), F.col("quantity_on_hand").cast("string"),
        F.lit(", reorder level: "), F.col("reorder_level").cast("string"))
    return _running_low(products).select("product_name", "quantity_on_hand", "reorder_level", text.alias("text"))


SQL_FUNCTIONS = (
    """
    CREATE OR REPLACE TEMPORARY FUNCTION top_selling_products(
      n INT DEFAULT 5 COMMENT 'number of products to return, best revenue first')
    RETURNS TABLE(product_name STRING, category_name STRING, units_sold BIGINT, revenue DECIMAL(38,2))
    COMMENT 'Best selling products by revenue, with their category.'
    RETURN
      WITH sold AS (
        SELECT product_id, SUM(quantity) AS units, SUM(quantity * unit_price) AS amount
        FROM order_items GROUP BY product_id),
      named AS (
        SELECT product_name, category_id, SUM(units) AS units, SUM(amount) AS amount
        FROM sold JOIN products USING (product_id) GROUP BY product_name, category_id),
      grouped AS (
        SELECT product_name, category_name, SUM(units) AS units_sold, SUM(amount) AS revenue
        FROM named JOIN categories USING (category_id) GROUP BY product_name, category_name),
      placed AS (
        SELECT *, ROW_NUMBER() OVER (ORDER BY revenue DESC, product_name, category_name) AS place FROM grouped)
      SELECT product_name, category_name, units_sold, revenue FROM placed WHERE place <= n ORDER BY revenue DESC, place
    """,
    """
    CREATE OR REPLACE TEMPORARY FUNCTION customer_order_history(
      cust_id BIGINT COMMENT 'customer whose orders to list')
    RETURNS TABLE(order_id BIGINT, order_date TIMESTAMP_NTZ, status STRING, item_count BIGINT, order_total DECIMAL(38,2))
    COMMENT 'Orders of one customer with item count and total.'
    RETURN
      SELECT order_id, order_date, status, COUNT(order_item_id), SUM(quantity * unit_price)
      FROM orders JOIN order_items USING (order_id)
      WHERE customer_id = cust_id
      GROUP BY order_id, order_date, status
      ORDER BY order_date, order_id
    """,
    """
    CREATE OR REPLACE TEMPORARY FUNCTION low_stock_products()
    RETURNS TABLE(product_name STRING, quantity_on_hand INT, reorder_level INT, supplier_name STRING)
    COMMENT 'Products still sold at or below their reorder level, with supplier.'
    RETURN
      SELECT product_name, quantity_on_hand, reorder_level, supplier_name
      FROM products JOIN suppliers USING (supplier_id)
      WHERE quantity_on_hand <= reorder_level AND discontinued = false
    """,
    """
    CREATE OR REPLACE TEMPORARY FUNCTION monthly_revenue()
    RETURNS TABLE(month STRING, revenue DECIMAL(38,2), order_count BIGINT)
    COMMENT 'Revenue and distinct orders per calendar month.'
    RETURN
      WITH per_order AS (
        SELECT order_id, SUM(quantity * unit_price) AS amount FROM order_items GROUP BY order_id)
      SELECT date_format(order_date, 'yyyy-MM') AS month, SUM(amount), COUNT(DISTINCT order_id)
      FROM orders JOIN per_order USING (order_id)
      GROUP BY date_format(order_date, 'yyyy-MM')
      ORDER BY month
    """,
)


def register_sql_functions(spark: SparkSession, frames: dict[str, DataFrame]) -> None:
    """Make the four questions callable from SQL. ``frames`` maps order_items, orders,
    products, categories and suppliers to DataFrames."""
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)
    for statement in SQL_FUNCTIONS:
        spark.sql(statement)
