"""Projections, filters and predicates."""

from pyspark.sql import functions as F

from larkspur.functions.arrays import joined, negatives_to_zero
from larkspur.operators.filters import in_period, near_median, not_in
from larkspur.plans.registry import query
from larkspur.session import materialize


@query("project_columns", "SELECT review_id, stars FROM reviews_v")
def project_columns(t):
    return t.reviews.select("review_id", "stars")


@query("drop_columns", """
    SELECT id, neighbourhood_group, neighbourhood, room_type, price, number_of_reviews,
           last_review, availability_365 FROM listings_v""")
def drop_columns(t):
    return t.listings.drop("latitude", "longitude")


@query("rename_columns", "SELECT conv_id, turn, business_id, text AS tip_text FROM tips_v")
def rename_columns(t):
    return t.tips.withColumnRenamed("text", "tip_text")


@query("derive_columns", """
    SELECT id, price, number_of_reviews, round(price / (1 + number_of_reviews), 6) AS price_per_review,
           neighbourhood || '/' || neighbourhood_group AS area
    FROM listings_v""")
def derive_columns(t):
    return t.listings.select(
        "id",
        "price",
        "number_of_reviews",
        F.round(F.col("price") / (1 + F.col("number_of_reviews")), 6).alias("price_per_review"),
        F.concat_ws("/", "neighbourhood", "neighbourhood_group").alias("area"),
    )


@query("filter_equality", """
    SELECT id, room_type, price FROM listings_v
    WHERE neighbourhood = 'NATION_6' AND neighbourhood_group = 'AMERICA'""")
def filter_equality(t):
    place = (F.col("neighbourhood") == "NATION_6") & (F.col("neighbourhood_group") == "AMERICA")
    return t.listings.filter(place).select("id", "room_type", "price")


@query("filter_contains", """
    SELECT business_id, categories FROM business_v WHERE contains(categories, 'Restaurants')""")
def filter_contains(t):
    return t.business.filter(F.col("categories").contains("Restaurants")).select("business_id", "categories")


@query("filter_regex_any", """
    SELECT business_id, categories FROM business_v
    WHERE regexp_matches(categories, 'Chinese|Fast Food|Italian|Pizza|Sandwiches')""")
def filter_regex_any(t):
    kinds = "Chinese|Fast Food|Italian|Pizza|Sandwiches"
    return t.business.filter(F.col("categories").rlike(kinds)).select("business_id", "categories")


@query("dropna_subset", "SELECT business_id, name, categories FROM business_v WHERE categories IS NOT NULL")
def dropna_subset(t):
    return t.business.select("business_id", "name", "categories").na.drop(subset=["categories"])


@query("dropna_any", """
    SELECT id, price, number_of_reviews, last_review FROM listings_v
    WHERE id IS NOT NULL AND price IS NOT NULL AND number_of_reviews IS NOT NULL AND last_review IS NOT NULL""")
def dropna_any(t):
    return t.listings.select("id", "price", "number_of_reviews", "last_review").na.drop("any")


@query("fillna_strings", """
    SELECT business_id, coalesce(city, 'an') AS city, coalesce(categories, 'an') AS categories
    FROM business_v""")
def fillna_strings(t):
    return t.business.select("business_id", "city", "categories").na.fill("an")


@query("filter_not_in", """
    SELECT business_id, categories FROM business_v
    WHERE categories IS NULL OR categories NOT IN ('Shopping, Fashion', 'Restaurants, Nightlife')""")
def filter_not_in(t):
    unwanted = ["Shopping, Fashion", "Restaurants, Nightlife"]
    return t.business.filter(not_in(F.col("categories"), unwanted)).select("business_id", "categories")


NEAR_SQL = """near_lat AS (
        SELECT * FROM listings_v WHERE abs(latitude - (SELECT median(latitude) FROM listings_v)) < 0.08),
    near AS (
        SELECT * FROM near_lat WHERE abs(longitude - (SELECT median(longitude) FROM near_lat)) < 0.08)"""


def listings_near_centre(t, *columns):
    """Listings near the median latitude, and then near the median longitude of those."""
    places = materialize(t.listings.select("latitude", "longitude", *columns), "places")
    return near_median(near_median(places, "latitude", 0.08), "longitude", 0.08)


@query("outlier_median", f"""
    WITH {NEAR_SQL}
    SELECT id, price, round(latitude, 6) AS latitude, round(longitude, 6) AS longitude FROM near""")
def outlier_median(t):
    near = listings_near_centre(t, "id", "price")
    return near.select(
        "id", "price", F.round("latitude", 6).alias("latitude"), F.round("longitude", 6).alias("longitude")
    )


@query("time_slice", """
    SELECT o_orderkey, o_orderdate, o_totalprice FROM orders
    WHERE o_orderdate >= DATE '1997-03-01' AND o_orderdate < DATE '1998-01-01'""")
def time_slice(t):
    orders = t.read("orders").filter(in_period(F.col("o_orderdate"), "1997-03", "1997-12"))
    return orders.select("o_orderkey", "o_orderdate", "o_totalprice")


@query("array_replace_negative", """
    SELECT vec_id, array_to_string(list_transform(y2_raw, lambda v: CASE WHEN v = -1 THEN 0 ELSE v END), ',')
           AS y2 FROM food_v""")
def array_replace_negative(t):
    return t.food.select("vec_id", joined(negatives_to_zero(F.col("y2_raw"))).alias("y2"))


@query("filter_correct_class", """
    SELECT vec_id, class_id, pred FROM (
        SELECT vec_id, class_id, CAST(list_position(scores, list_max(scores)) AS INTEGER) AS pred FROM food_v)
    WHERE pred = class_id AND class_id = 3""")
def filter_correct_class(t):
    best = F.array_position("scores", F.array_max("scores")).cast("int")
    food = t.food.select("vec_id", "class_id", best.alias("pred"))
    return food.filter((F.col("pred") == F.col("class_id")) & (F.col("class_id") == 3))
