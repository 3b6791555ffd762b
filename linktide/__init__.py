"""Link-graph ranking on Spark: wiki dump in, ranked pages out."""

from linktide.operators.graph import Graph, clean_graph
from linktide.operators.rank import rank_graph
from linktide.plans.rank_dump import rank_dump
from linktide.scratch import Scratch

__all__ = ["Graph", "Scratch", "clean_graph", "rank_dump", "rank_graph"]
