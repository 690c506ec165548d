"""Validation of a product whose tables are made from the driver's, defects included."""

from __future__ import annotations

from pyspark.sql import functions as F

from cairn.operators import product
from cairn.plans.registry import query
from cairn.plans.roles import tables

_RECORD = "concat_ws('|', l_orderkey, l_linenumber, l_partkey % 50)"
_KEYS = ("MAIL", "AIR", "SHIP")

_TABLES = f"""labs AS (SELECT {_RECORD} AS record_id, CASE WHEN l_suppkey % 37 = 0 THEN 'vitals' ELSE 'labs' END AS domain, CASE WHEN l_partkey % 41 <> 0 THEN 'lab' || CAST(l_suppkey % 3 AS VARCHAR) END AS source_file, CASE WHEN l_partkey % 43 <> 0 THEN l_linenumber END AS row_number, l_partkey, l_quantity FROM lineitem),
visits AS (SELECT CAST(o_orderkey AS VARCHAR) AS record_id, 'encounter' AS domain, 'enc' AS source_file, o_orderkey AS row_number FROM orders),
member AS (SELECT CASE WHEN l_partkey % 29 = 0 THEN 'none' ELSE 'e' || CAST(l_partkey % 20 AS VARCHAR) END AS element_id, CASE WHEN l_quantity = 50 THEN 'lost' ELSE record_id END AS record_id, 'labs' AS domain, l_quantity > 5 AS include FROM labs),
elements AS (SELECT 'e' || CAST(p_partkey % 20 AS VARCHAR) AS element_id, CASE WHEN p_partkey % 20 < 15 THEN 'source_concept' ELSE 'derived' END AS element_kind FROM part WHERE p_partkey <= 25),
rul AS (SELECT 'e' || CAST(p_partkey % 20 AS VARCHAR) AS element_id, p_partkey % 20 > 3 AS include FROM part),
obs AS (SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'MAIL' WHEN '2-HIGH' THEN 'AIR' WHEN '3-MEDIUM' THEN 'SHIP' ELSE 'OTHER' END AS output_key, o_orderstatus AS category, CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderstatus END AS label FROM orders)"""

_SQL = f"""WITH {_TABLES}
SELECT 'missing_tables' AS error, CAST(1 AS BIGINT) AS n UNION ALL SELECT 'schema.visits', 0 UNION ALL SELECT 'schema.element_catalog', 1
UNION ALL SELECT 'manifest.not_single', 0 UNION ALL SELECT 'manifest.status', 1 UNION ALL SELECT 'manifest.version', 0
UNION ALL SELECT 'label_disagrees', count(*) FILTER (WHERE coalesce(label, '') <> category) FROM obs UNION ALL SELECT 'unknown_output_keys', count(*) FILTER (WHERE output_key = 'OTHER') FROM obs
UNION ALL SELECT 'memberships_not_reconciled', count(*) FILTER (WHERE o_orderkey % 101 = 0) FROM obs
UNION ALL SELECT 'output_manifest.incomplete', 1 UNION ALL SELECT 'output_manifest.row_count', 1 UNION ALL SELECT 'output_manifest.columns', 0 UNION ALL SELECT 'output_manifest.digest', 0
UNION ALL SELECT 'without_provenance.labs', count(*) FILTER (WHERE source_file IS NULL OR row_number IS NULL) FROM labs UNION ALL SELECT 'wrong_domain.labs', count(*) FILTER (WHERE domain <> 'labs') FROM labs UNION ALL SELECT 'empty.labs', CASE WHEN count(*) = 0 THEN 1 ELSE 0 END FROM labs
UNION ALL SELECT 'without_provenance.visits', 0 UNION ALL SELECT 'wrong_domain.visits', 0 UNION ALL SELECT 'empty.visits', CASE WHEN count(*) = 0 THEN 1 ELSE 0 END FROM visits
UNION ALL SELECT 'duplicate_record_ids', coalesce(sum(n - 1), 0) FROM (SELECT count(*) AS n FROM (SELECT record_id FROM labs UNION ALL SELECT record_id FROM visits) GROUP BY record_id)
UNION ALL SELECT 'orphan_memberships', count(*) FROM member WHERE record_id NOT IN (SELECT record_id FROM labs)
UNION ALL SELECT 'retained_without_membership.labs', count(*) FROM labs WHERE record_id NOT IN (SELECT record_id FROM member WHERE include)
UNION ALL SELECT 'files_in_several_domains', count(*) FROM (SELECT source_file FROM labs WHERE source_file IS NOT NULL GROUP BY 1 HAVING count(DISTINCT domain) > 1)
UNION ALL SELECT 'duplicate_elements', count(*) FROM (SELECT 1 FROM elements GROUP BY element_id HAVING count(*) > 1)
UNION ALL SELECT 'unknown_elements', count(*) FROM member WHERE element_id NOT IN (SELECT element_id FROM elements)
UNION ALL SELECT 'elements_without_included_rule', count(DISTINCT element_id) FROM elements WHERE element_kind = 'source_concept' AND element_id NOT IN (SELECT element_id FROM rul WHERE include)"""


@query("op_K30_product", _SQL)
def _(v):
    li, o, p = tables(v.spark, v.dir, "lineitem", "orders", "part")
    labs = li.select(
        F.expr(_RECORD).alias("record_id"), F.when(F.col("l_suppkey") % 37 == 0, "vitals").otherwise("labs").alias("domain"), F.when(F.col("l_partkey") % 41 != 0, F.concat(F.lit("lab"), (F.col("l_suppkey") % 3).cast("string"))).alias("source_file"),
        F.when(F.col("l_partkey") % 43 != 0, F.col("l_linenumber")).alias("row_number"), "l_partkey", "l_quantity",
    )
    visits = o.select(F.col("o_orderkey").cast("string").alias("record_id"), F.lit("encounter").alias("domain"), F.lit("enc").alias("source_file"), F.col("o_orderkey").alias("row_number"))
    element = lambda c: F.concat(F.lit("e"), (F.col(c) % 20).cast("string"))
    member = labs.select(F.when(F.col("l_partkey") % 29 == 0, "none").otherwise(element("l_partkey")).alias("element_id"), F.when(F.col("l_quantity") == 50, "lost").otherwise(F.col("record_id")).alias("record_id"), F.lit("labs").alias("domain"), (F.col("l_quantity") > 5).alias("include"))
    catalog = p.filter("p_partkey <= 25").select(element("p_partkey").alias("element_id"), F.when(F.col("p_partkey") % 20 < 15, "source_concept").otherwise("derived").alias("element_kind"))
    keys = F.when(F.col("o_orderpriority") == "1-URGENT", "MAIL").when(F.col("o_orderpriority") == "2-HIGH", "AIR").when(F.col("o_orderpriority") == "3-MEDIUM", "SHIP").otherwise("OTHER")
    obs = o.select("o_orderkey", keys.alias("output_key"), F.col("o_orderstatus").alias("category"), F.when(F.col("o_orderkey") % 11 == 0, None).otherwise(F.col("o_orderstatus")).alias("label"))
    # AIR is listed with a row too many, SHIP isn't listed at all
    listed = obs.filter("output_key in ('MAIL', 'AIR')").groupBy("output_key").agg((F.count("*") + F.max((F.col("output_key") == "AIR").cast("int"))).alias("row_count")).select("output_key", "row_count", F.lit(None).cast("string").alias("digest"), F.lit("o_orderkey,category").alias("columns"))
    contract = product.Contract(
        required=("manifest", "labs", "visits", "vitals"), sources={"labs": "labs", "visits": "encounter"}, manifest={"status": "complete", "version": "2"}, outputs=_KEYS, output_columns=("o_orderkey", "category"),
        schemas={"visits": "record_id string, domain string, source_file string, row_number bigint", "element_catalog": "element_id string, element_kind string, name string"},
    )
    made = {
        "manifest": v.spark.createDataFrame([("building", "2")], "status string, version string"), "labs": labs, "visits": visits, "observations": obs, "memberships": obs.filter("o_orderkey % 101 <> 0"), "output_manifest": listed, "element_catalog": catalog,
        "element_rule": p.select(element("p_partkey").alias("element_id"), (F.col("p_partkey") % 20 > 3).alias("include")), "element_membership": member, "inventory": labs.filter("source_file is not null").select(F.col("source_file").alias("path"), "domain"),
    }
    return product.validate(v.spark, made, contract)
