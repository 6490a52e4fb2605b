"""Hierarchies (H1-H5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog import query
from millrace.catalog import mapping as m
from millrace.catalog.mapping import ctes
from millrace.operators import tree


def _nodes(t):
    d = m.depart(t)
    return d.select(
        F.col("dd_id").alias("id"),
        F.col("dd_parent_id").alias("parent_id"),
        F.col("dd_name").alias("name"),
        "code",
        F.col("dd_deleted_time").alias("deleted_time"),
    )


_PATHS = """, walk AS (
  SELECT dd_id AS id, dd_name AS complete_name, dd_id || '/' AS parent_path FROM {0} WHERE dd_parent_id IS NULL
  UNION ALL
  SELECT d.dd_id, w.complete_name || ' / ' || d.dd_name, w.parent_path || d.dd_id || '/'
  FROM {0} d JOIN walk w ON d.dd_parent_id = w.id)
SELECT d.dd_id AS id, w.complete_name, w.parent_path FROM {0} d LEFT JOIN walk w ON w.id = d.dd_id"""


@query("tree_paths", ctes("depart") + _PATHS.format("depart"))
def tree_paths(t):
    return tree.tree_paths(_nodes(t)).select("id", "complete_name", "parent_path")


@query(
    "tree_paths_orphans",
    ctes("depart") + ", live AS (SELECT * FROM depart WHERE dd_deleted_time IS NULL)" + _PATHS.format("live"),
)
def tree_paths_orphans(t):
    """Live rows only: whole branches hang under deleted rows and stay without a path."""
    live = _nodes(t).filter(F.col("deleted_time").isNull())
    return tree.tree_paths(live).select("id", "complete_name", "parent_path")


@query(
    "inherit_from_ancestor",
    ctes("depart")
    + """, walk AS (
      SELECT dd_id AS id, dd_parent_id AS up, code, 0 AS level FROM depart
      UNION ALL
      SELECT w.id, d.dd_parent_id, d.code, w.level + 1 FROM walk w JOIN depart d ON d.dd_id = w.up
      WHERE w.code IS NULL)
    SELECT id, arg_min(code, level) FILTER (WHERE code IS NOT NULL) AS code FROM walk GROUP BY id""",
)
def inherit_from_ancestor(t):
    return tree.inherit_from_ancestor(_nodes(t)).select("id", "code")


@query(
    "leaf_flag",
    ctes("depart")
    + """ SELECT dd_id AS id, NOT EXISTS (SELECT 1 FROM depart c WHERE c.dd_parent_id = d.dd_id) AS is_leaf
    FROM depart d""",
)
def leaf_flag(t):
    return tree.leaf_flag(_nodes(t)).select("id", "is_leaf")


@query("children_of", ctes("depart") + " SELECT dd_id AS id, dd_name AS name FROM depart WHERE dd_parent_id = 4")
def children_of(t):
    return tree.children_of(_nodes(t), 4).select("id", "name")


@query(
    "dangling_parents",
    ctes("depart")
    + """ SELECT c.dd_id AS id, c.dd_parent_id AS parent_id FROM depart c LEFT JOIN depart p
    ON c.dd_parent_id = p.dd_id WHERE c.dd_deleted_time IS NULL AND p.dd_deleted_time IS NOT NULL""",
)
def dangling_parents(t):
    return tree.dangling_parents(_nodes(t)).select("id", "parent_id")


#: Rings of up to nine rows among the customers of each hundred, ways into them, and the tree for all others.
_RINGS = """, ringed AS (SELECT c_custkey AS id, CASE
      WHEN c_custkey % 100 < 9 THEN c_custkey - c_custkey % 100 + (c_custkey % 100 + 1) % (1 + c_custkey // 100 % 9)
      WHEN c_custkey % 100 < 30 THEN c_custkey - 7
      WHEN c_custkey % 100 < 90 THEN c_custkey - c_custkey % 100 + 95 END AS parent_id FROM customer)"""


def _ringed(t):
    k = F.col("c_custkey")
    within, ring = k % 100, F.lit(1) + F.floor(k / 100).cast("long") % 9
    up = F.when(within < 9, k - within + (within + 1) % ring).when(within < 30, k - 7).when(within < 90, k - within + 95)
    return t.customer.select(k.alias("id"), up.alias("parent_id"))


@query(
    "cycle_members",
    "WITH RECURSIVE x AS (SELECT 1)"
    + _RINGS
    + """, walk AS (SELECT id, parent_id AS at, 1 AS step, least(id, parent_id) AS least FROM ringed WHERE parent_id IS NOT NULL
      UNION ALL SELECT w.id, r.parent_id, w.step + 1, least(w.least, r.parent_id) FROM walk w JOIN ringed r ON r.id = w.at
      WHERE r.parent_id IS NOT NULL AND w.step < 10 AND w.at <> w.id)
    SELECT r.id, r.parent_id, w.least AS cycle FROM ringed r LEFT JOIN walk w ON w.id = r.id AND w.at = r.id""",
)
def cycle_members(t):
    """Which rows lie on a cycle, and the smallest row of it."""
    return tree.cycle_members(_ringed(t))


@query("update_paths", ctes("depart") + """, changed AS (SELECT * REPLACE (
      CASE WHEN dd_id % 90 = 11 THEN dd_name || ' moved' ELSE dd_name END AS dd_name,
      CASE WHEN dd_id % 70 = 33 THEN dd_id % 7 + 1 ELSE dd_parent_id END AS dd_parent_id)
      FROM depart WHERE dd_id % 120 <> 55)""" + _PATHS.format("changed"))
def update_paths(t):
    """Paths of a changed snapshot from those of the last: some rows were renamed, some moved, some went."""
    old = _nodes(t)
    name = F.when(F.col("id") % 90 == 11, F.concat("name", F.lit(" moved"))).otherwise(F.col("name"))
    up = F.when(F.col("id") % 70 == 33, F.col("id") % 7 + 1).otherwise(F.col("parent_id"))
    new = old.withColumns({"name": name, "parent_id": up}).filter("id % 120 <> 55")
    return tree.update_paths(tree.tree_paths(old), new).select("id", "complete_name", "parent_path")
