"""Counting the occurrences of many phrases in one pass of a text."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark import Broadcast
from pyspark.sql import functions as F

_MATCHES = "array<struct<group_idx:int,hits:bigint>>"


class Phrases:
    """An automaton over the phrases of all groups; empty phrases occur nowhere."""

    def __init__(self, groups: Sequence[tuple[int, Sequence[str]]]):
        import ahocorasick

        owners = defaultdict(list)  # a phrase counts as often as its group names it
        for group, phrases in groups:
            for phrase in filter(None, phrases):
                owners[phrase].append(group)
        self.automaton = ahocorasick.Automaton()
        for n, (phrase, own) in enumerate(owners.items()):
            self.automaton.add_word(phrase, (n, len(phrase), own))
        self.empty = not owners
        if owners:
            self.automaton.make_automaton()

    def add_hits(self, text: str, hits: dict[int, int]) -> None:
        """Occurrences of each phrase, without overlaps of it with itself."""
        if self.empty or not text:
            return
        free: dict[int, int] = {}  # where the next occurrence of a phrase may begin
        for end, (phrase, length, groups) in self.automaton.iter(text):
            if end - length + 1 >= free.get(phrase, 0):
                free[phrase] = end + 1
                for group in groups:
                    hits[group] += 1


def phrase_counter(groups: Broadcast) -> Callable:
    """A function of two columns of lower-case text: the groups that occur in them, with their hits."""
    built: list[Phrases] = []  # once per worker process and task

    @F.pandas_udf(_MATCHES)
    def count(title: pd.Series, text: pd.Series) -> pd.Series:
        if not built:
            built.append(Phrases(groups.value))
        out = []
        for parts in zip(title, text, strict=True):
            hits: dict[int, int] = defaultdict(int)
            for part in parts:
                built[0].add_hits(part, hits)
            out.append([{"group_idx": g, "hits": n} for g, n in sorted(hits.items())])
        return pd.Series(out)

    return count
