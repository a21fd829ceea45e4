"""Entry points: build all tables from the three sources, compare tags.

``TagTables`` holds lazy DataFrames only; nothing runs until an action or a
write. Each property is one Catalyst plan over the sources, so reading only
``tech_rel`` touches only the posts' id/tags/counts columns.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame

from ..operators import compare as cmp
from ..operators import graph as g
from ..operators import rollup
from ..operators import tags as t
from ..operators import totals as tot
from ..sources.fixtures import Sources


class TagTables:
    def __init__(self, sources: Sources | None, given: dict[str, DataFrame] | None = None):
        """``given`` supplies tables that already exist (written earlier, or
        staged); every other table is derived from them or from ``sources``."""
        self.sources = sources
        self._given = set(given or ())
        for name, df in (given or {}).items():
            self.__dict__[name] = df            # takes the place of the cached property

    @classmethod
    def from_frames(cls, posts: DataFrame, comments: DataFrame, users: DataFrame,
                    **kw) -> "TagTables":
        return cls(Sources(posts, comments, users), **kw)

    @cached_property
    def post_tags(self) -> DataFrame:
        return t.post_tags(self.sources.posts)

    @cached_property
    def tag_tokens(self) -> DataFrame:
        return t.tag_tokens(self.post_tags)

    @cached_property
    def tag_pairs(self) -> DataFrame:
        return t.tag_pairs(self.post_tags)

    @cached_property
    def tech_rel(self) -> DataFrame:
        return tot.tech_rel(self.post_tags)

    @cached_property
    def tech_node(self) -> DataFrame:
        return tot.tech_node(self.post_tags)

    @cached_property
    def tag_date(self) -> DataFrame:
        return tot.tag_date(self.post_tags)

    @cached_property
    def tag_list(self) -> DataFrame:
        return tot.tag_list(self.post_tags)

    @cached_property
    def user_tech(self) -> DataFrame:
        return tot.user_tech(self.post_tags, self.sources.comments, self.sources.users)

    @cached_property
    def user_tech_list(self) -> DataFrame:
        return tot.user_tech_list(self.user_tech)

    @cached_property
    def graph_vertices(self) -> DataFrame:
        return g.graph_vertices(self.tech_node)

    @cached_property
    def graph_edges(self) -> DataFrame:
        # J3 is a no-op when both tables come from the same posts (see
        # graph.graph_edges); given (stored) tables keep the semi joins
        same_posts = "tech_rel" not in self._given and "tech_node" not in self._given
        return g.graph_edges(self.tech_rel, None if same_posts else self.tech_node)

    @cached_property
    def tag_rollup(self) -> DataFrame:
        return rollup.tag_rollup(self.tag_date)

    @cached_property
    def user_vertices(self) -> DataFrame:
        return g.user_vertices(self.user_tech)

    @cached_property
    def contribute_edges(self) -> DataFrame:
        return g.contribute_edges(self.user_tech, self.tech_node)

    @property
    def trend_rows(self) -> DataFrame:
        """What the monthly trend sums: the stored month nodes, the days if there are none."""
        return rollup.months(self.tag_rollup) if "tag_rollup" in self._given else self.tag_date

    # the stored tables, by name (what ``sinks.write_tables`` persists)
    STORED = ("tech_rel", "tech_node", "tag_date", "tag_list", "user_tech",
              "graph_vertices", "graph_edges", "tag_rollup", "user_vertices", "contribute_edges")

    def stored(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in self.STORED}


def build_tables(posts: DataFrame, comments: DataFrame, users: DataFrame) -> TagTables:
    return TagTables.from_frames(posts, comments, users)


def compare(tables: TagTables, tech: str, tech_with: str, tech_or: str) -> dict[str, DataFrame]:
    """The page's four sections for ``tech`` against ``tech_with`` and
    ``tech_or`` (plus the second comparison of sections 3 and 4)."""
    trend = cmp.monthly_trend(tables.trend_rows, tech, tech_with, tech_or)
    bars = cmp.compare_edge_long(tables.tech_rel, tech, [tech_with, tech_or])
    return {
        "compare_edge": cmp.compare_edge(tables.tech_rel, tables.tech_node, tech,
                                         [tech_with, tech_or]),
        "compare_edge_long": bars,
        "bar_extents": cmp.bar_extents(bars),
        "monthly_trend": trend,
        "trend_extents": cmp.trend_extents(trend),
        "common_contributors": cmp.common_contributors(tables.user_tech, tech, tech_with),
        "common_contributors_or": cmp.common_contributors(tables.user_tech, tech, tech_or),
        "related_graph_nodes": cmp.related_graph_nodes(tables.graph_edges, tech, tech_with),
        "related_graph_edges": cmp.related_graph_edges(tables.graph_edges, tech, tech_with),
        "related_graph_nodes_or": cmp.related_graph_nodes(tables.graph_edges, tech, tech_or),
        "related_graph_edges_or": cmp.related_graph_edges(tables.graph_edges, tech, tech_or),
    }
