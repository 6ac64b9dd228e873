"""Entities in text with evidence, their merging, and excerpts of conversations."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: What each kind of entity looks like (kinds with Cyrillic labels need them next to the number).
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
    "url": r"https?://[^\s<>\"]+",
    "phone": r"(?<!\d)\+?\d[\d ()-]{8,14}\d(?!\d)",
    "inn": r"(?iu)инн\D{0,3}(\d{12}|\d{10})(?!\d)",
    "kpp": r"(?iu)кпп\D{0,3}(\d{9})(?!\d)",
    "ogrn": r"(?iu)огрн(?:ип)?\D{0,3}(\d{15}|\d{13})(?!\d)",
    "ip": r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?![\d.])",
    "secret": r"(?i)\b(?:token|password|secret|api[_-]?key)\s*[=:]\s*\"?[^\s\"]{8,}",
}


def _labelled(kind: str):
    return lambda v, i: F.struct(F.lit(kind).alias("kind"), i.alias("pos"), F.btrim(F.lower(v), F.lit(" .,:;)")).alias("value"))


def entity_values(docs: DataFrame, id_col: str, text_col: str, patterns: Mapping[str, str] = PATTERNS) -> DataFrame:
    """One row per entity found: id, kind, position in kind, value (lower case). Native; the regexes need no offsets."""
    found = None
    for kind, p in patterns.items():
        groups = re.compile(re.sub(r"\(\?[a-z]+\)", "", p)).groups
        values = F.regexp_extract_all(F.coalesce(F.col(text_col), F.lit("")), F.lit(p), F.lit(1 if groups else 0))
        column = F.transform(values, _labelled(kind))
        found = column if found is None else F.concat(found, column)
    return docs.select(id_col, F.explode(found).alias("e")).select(id_col, "e.*").filter(F.col("value") != "")


def entity_snippets(docs: DataFrame, id_col: str, text_col: str, patterns: Mapping[str, str] = PATTERNS, around: int = 120) -> DataFrame:
    """The same with the offset of each entity and the text around it, from an Arrow-batched pass."""
    compiled = {k: re.compile(p) for k, p in patterns.items()}

    def find(batches):
        for pdf in batches:
            rows = [
                (i, kind, m.start(), (m.group(1) if p.groups else m.group(0)).lower().strip(" .,:;)"), " ".join(t[max(0, m.start() - around) : m.end() + around].split()))
                for i, t in zip(pdf[id_col], pdf[text_col].fillna(""), strict=True) for kind, p in compiled.items() for m in p.finditer(t)
            ]
            yield pd.DataFrame(rows, columns=[id_col, "kind", "start", "value", "snippet"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInPandas(find, f"{id_col} {kind}, kind string, start int, value string, snippet string")


def merge_entities(found: DataFrame, kind: str, value: str, holder: str, order: Sequence[str]) -> DataFrame:
    """One row per (kind, value): where it is first found, in how many rows and how often."""
    return found.groupBy(kind, value).agg(F.min(F.struct(*order)).alias("first"), F.count_distinct(holder).alias("n_holders"), F.count(F.lit(1)).alias("n_mentions")).select(
        kind, value, *[F.col(f"first.{c}").alias(f"first_{c}") for c in order], "n_holders", "n_mentions"
    )


def excerpt(turns: DataFrame, key: str, order: str, text_col: str, primary: Sequence[str], limit: int = 1000, start: float = 0.72) -> DataFrame:
    """Per key the best turns within a budget of characters, in their order: those that score 3 or more up to 72 %, then the rest.

    Filling is greedy, so each key is one group of pandas; a key's turns are a conversation, which fits one task. Score: 6 and the number of
    primary words up to 4, colons and digits 1 each, 2 for the first two turns, -1 above 280 characters.
    """

    def score(text: str, i: int) -> float:
        low = text.lower()
        hits = sum(w in low for w in primary)
        return (6 + min(hits, 4) if hits else 0) + (":" in text) + any(c.isdigit() for c in text) + 2 * (i < 2) - (len(text) > 280)

    def fill(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order, kind="stable")
        chunks = [" ".join(t.split()) for t in pdf[text_col].fillna("")]
        scores = [score(t, i) for i, t in enumerate(chunks)]
        kept, used = set(), 0
        for least, part in ((3, start), (0, 1.0)):
            for i in sorted(range(len(chunks)), key=lambda i: (-scores[i], i)):
                if i not in kept and chunks[i] and scores[i] >= least and used + len(chunks[i]) <= limit * part:
                    kept.add(i)
                    used += len(chunks[i])
        return pd.DataFrame({key: [pdf[key].iloc[0]], "n_kept": [len(kept)], "n_chars": [used], "excerpt": ["\n".join(chunks[i] for i in sorted(kept))]})

    kind = turns.schema[key].dataType.simpleString()
    return turns.select(key, order, text_col).groupBy(key).applyInPandas(fill, f"{key} {kind}, n_kept int, n_chars int, excerpt string")
