"""Brute-force models in plain Python, for small inputs."""

from __future__ import annotations

from fractions import Fraction


def induced_edges(nodes, links):
    return {(s, d) for s, d in links if s in nodes and d in nodes}


def masses_and_ranks(nodes, edges, rounds, damping=Fraction(85, 100)):
    """Exact masses entering each round and ranks after each round."""
    nodes = set(nodes)
    degree = dict.fromkeys(nodes, 0)
    for src, _ in edges:
        degree[src] += 1
    rank = dict.fromkeys(nodes, Fraction(1))
    masses, ranks = [], []
    for _ in range(rounds):
        sink = sum((rank[n] for n in nodes if not degree[n]), Fraction(0))
        masses.append((sum(rank.values()), sink))
        received = dict.fromkeys(nodes, Fraction(0))
        for src, dst in edges:
            received[dst] += rank[src] / degree[src]
        rank = {
            n: 1 - damping + damping * (received[n] + sink / len(nodes)) for n in nodes
        }
        ranks.append(rank)
    return masses, ranks


def links_in(text):
    """The raw links of a text, found by walking it."""
    found, at = [], 0
    while (begin := text.find("[[", at)) >= 0 and (end := text.find("]]", begin)) >= 0:
        found.append(text[begin + 2 : end])
        at = end
    return found
