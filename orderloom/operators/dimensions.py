"""Product, sales organisation and customer attributes.

No broadcast is forced: Spark broadcasts a side when its size, estimated or measured at run
time, is below the threshold, and shuffles it otherwise.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _lookup(tables: Mapping[str, DataFrame], table: str, key: str, **columns: str) -> DataFrame:
    """Columns of a table under new names, with its id as `key`."""
    picked = [F.col(old).alias(new) for new, old in columns.items()]
    return tables[table].select(F.col("id").alias(key), *picked)


def edition_products(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Edition, title and title types by product id (`saleable_id`)."""
    products = _lookup(
        tables, "edition_product_types", "saleable_id", edition_id="edition_id", ref_code="ref_code"
    )
    editions = _lookup(tables, "editions", "edition_id", edition_name="name", title_id="title_id")
    titles = _lookup(
        tables, "titles", "title_id", catalog_title="name",
        type_id="master_title_type_id", sub_type_id="master_title_sub_type_id",
    )
    types = _lookup(tables, "master_title_types", "type_id", master_title_type="name")
    sub_types = _lookup(
        tables, "master_title_sub_types", "sub_type_id", master_title_sub_type="name"
    )
    titles = titles.join(types, "type_id", "left").join(sub_types, "sub_type_id", "left")
    return products.join(editions.join(titles, "title_id", "left"), "edition_id", "left").select(
        "saleable_id", "edition_name", "ref_code", "catalog_title",
        "master_title_type", "master_title_sub_type",
    )


def customized_books(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Customised books by id (`saleable_id`), with the abbreviation of their meta data."""
    books = _lookup(
        tables, "customized_books", "saleable_id",
        book_title="name", meta_id="standard_meta_data_id",
    ).withColumn("is_book", F.lit(True))
    abbreviations = _lookup(tables, "standard_meta_data", "meta_id", book_abbr="abbr")
    return books.join(abbreviations, "meta_id", "left").drop("meta_id")


def standard_meta(tables: Mapping[str, DataFrame]) -> DataFrame:
    return _lookup(tables, "standard_meta_data", "itemParentable_id", standard_abbr="abbr")


def sales_organisation(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Branch, sales group and its manager's name by `branch_id`.

    A manager with several contact rows gives several rows per branch; `contacts` says how
    many. A name with any part missing is NULL.
    """
    people = tables["contact_individual_details"].select(
        "contact_id",
        F.concat("salutation", F.lit(" "), "first_name", F.lit(" "), "last_name").alias("rsm"),
    )
    people_counts = people.groupBy("contact_id").agg(F.count(F.lit(1)).alias("contacts"))
    branches = _lookup(
        tables, "branches", "branch_id", branch_name="name", sales_group_id="sales_group_id"
    )
    groups = _lookup(
        tables, "sales_groups", "sales_group_id", sales_group_name="name", employee_id="rsm"
    )
    employees = _lookup(tables, "employees", "employee_id", contact_id="contact_id")
    managers = groups.join(employees, "employee_id", "left").drop("employee_id")
    managers = managers.join(people_counts, "contact_id", "left").join(people, "contact_id", "left")
    return branches.join(managers.drop("contact_id"), "sales_group_id", "left")


def customers(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Customer name and category by customer id (`contactable_id`)."""
    names = _lookup(
        tables, "customers", "contactable_id", customer_name="billing_name", role_id="role_id"
    )
    roles = _lookup(tables, "c_roles", "role_id", customer_category="name")
    return names.join(roles, "role_id", "left").drop("role_id")
