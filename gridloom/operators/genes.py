"""Gene metadata: what a gene filter asks for is resolved from the table or from an annotation, and the filter's text is
translated to a predicate, never evaluated."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.files import gene_type_from_name

# The names that a gene's type, chromosome and id go by.
TYPES = ("gene_type", "gene_biotype", "biotype", "gene_type_ensembl")
CHROMOSOMES = ("gene_chrom", "chromosome", "chrom")
IDS = ("gene_id", "ensembl_gene_id")
_KEYS = ("condition_key", "condition", "cond")
_TOKEN = re.compile(r"""\s*(?:(?P<text>"[^"]*"|'[^']*')|(?P<number>-?\d+(?:\.\d+)?)|(?P<op>==|!=|<=|>=|<|>|\(|\)|\[|\]|,|&|\||~)|(?P<name>[A-Za-z_][A-Za-z_0-9.]*))""")


def expressions(entries: list[str]) -> list[str]:
    """The expressions of filter entries ``expr=...;condition_key=...`` or of plain ones."""
    out = []
    for entry in entries:
        found = None
        for part in (p.strip() for p in str(entry).split(";")):
            key, eq, value = part.partition("=")
            if eq and not value.startswith("=") and key.strip().lower() == "expr":
                found = value.strip()
            elif part and not (eq and key.strip().lower() in _KEYS) and found is None:
                found = part
        if found:
            out.append(found)
    return out


def _tokens(text: str) -> list[tuple[str, str]]:
    out, at = [], 0
    text = text.rstrip()
    while at < len(text):
        found = _TOKEN.match(text, at)
        if not found:
            raise ValueError(f"a gene filter can't be read at {text[at:]!r}")
        out.append((found.lastgroup, found[found.lastgroup]))
        at = found.end()
    return out


def columns_of(text: str) -> set[str]:
    """The columns that an expression names."""
    return {value for kind, value in _tokens(text) if kind == "name" and value.lower() not in ("and", "or", "not", "in", "not_in", "true", "false", "none")}


class _Parser:
    """``or`` over ``and`` over ``not`` over comparisons; ``x in [...]``, ``x not in [...]``, ``x not_in (...)``."""

    def __init__(self, text: str):
        self.tokens, self.at = _tokens(text), 0
        self.types = bool(columns_of(text) & set(TYPES))

    def peek(self) -> str:
        return self.tokens[self.at][1].lower() if self.at < len(self.tokens) else ""

    def take(self, *wanted: str) -> str:
        if self.peek() not in wanted:
            raise ValueError(f"a gene filter has {self.peek()!r} where one of {wanted} should stand")
        self.at += 1
        return self.tokens[self.at - 1][1]

    def whole(self) -> Column:
        out = self.either()
        if self.at < len(self.tokens):
            raise ValueError(f"a gene filter goes on with {self.peek()!r}")
        return out

    def either(self) -> Column:
        out = self.both()
        while self.peek() in ("or", "|"):
            self.at += 1
            out = out | self.both()
        return out

    def both(self) -> Column:
        out = self.negated()
        while self.peek() in ("and", "&"):
            self.at += 1
            out = out & self.negated()
        return out

    def negated(self) -> Column:
        if self.peek() in ("not", "~"):
            self.at += 1
            return ~self.negated()
        if self.peek() == "(":
            self.at += 1
            out = self.either()
            self.take(")")
            return out
        return self.compared()

    def compared(self) -> Column:
        left = self.value()
        word = self.peek()
        if word in ("==", "!=", "<", "<=", ">", ">="):
            self.at += 1
            right = self.value()
            return {"==": left == right, "!=": ~left.eqNullSafe(right), "<": left < right, "<=": left <= right, ">": left > right, ">=": left >= right}[word]
        if word in ("in", "not", "not_in"):
            self.at += 1
            if word == "not":
                self.take("in")
            held = left.isin(*self.listed())
            return held if word == "in" else ~F.coalesce(held, F.lit(False))
        return left

    def listed(self) -> list[Column]:
        close = {"[": "]", "(": ")"}[self.take("[", "(")]
        out = []
        while self.peek() != close:
            out.append(self.value())
            if self.peek() == ",":
                self.at += 1
        self.take(close)
        return out

    def value(self) -> Column:
        if self.at >= len(self.tokens):
            raise ValueError("a gene filter ends too early")
        kind, text = self.tokens[self.at]
        self.at += 1
        if kind == "text":
            text = text[1:-1]
            return F.lit(text.strip().lower().replace("-", "_") if self.types else text)
        if kind == "number":
            return F.lit(float(text))
        if kind != "name":
            raise ValueError(f"a gene filter has {text!r} where a value should stand")
        if text.lower() in ("true", "false"):
            return F.lit(text.lower() == "true")
        return F.lower(F.regexp_replace(F.trim(F.col(f"`{text}`")), "-", "_")) if text in TYPES else F.col(f"`{text}`")


def predicate(text: str) -> Column:
    """An expression over gene columns as a column: comparisons, lists, and, or, not. Types compare without regard to case
    or to hyphens, and all texts of an expression that names one do."""
    return _Parser(text).whole()


def resolve_metadata(var: DataFrame, needed: set[str], annotation: DataFrame | None = None) -> DataFrame:
    """Genes with the columns that are needed: those they have, other names of the same, those of an annotation by gene
    (gene_id and any of a type, chromosome, id), a type at last from the gene's name. What can't be had is an error."""
    out = var
    for family in (TYPES, CHROMOSOMES, IDS):
        for name in sorted(needed & set(family)):
            if name in out.columns:
                continue
            same = next((c for c in family if c in out.columns and c != "gene_id"), None)
            other = None if annotation is None else next((c for c in (name, *family) if c in annotation.columns and c != "gene_id"), None)
            if same:
                out = out.withColumn(name, F.col(same))
            elif other:
                side = annotation.groupBy("gene_id").agg(F.min(other).alias(name))
                out = out.join(side, "gene_id", "left")
                if family is TYPES:
                    out = out.withColumn(name, F.coalesce(name, gene_type_from_name(F.col("gene_id"))))
            elif family is TYPES:
                out = out.withColumn(name, gene_type_from_name(F.col("gene_id")))
    if "gene" in needed and "gene" not in out.columns:
        out = out.withColumn("gene", F.col("gene_id"))
    if missing := sorted(needed - set(out.columns)):
        raise ValueError(f"genes have no column {missing}")
    return out


def filter_genes(var: DataFrame, entries: list[str], annotation: DataFrame | None = None) -> DataFrame:
    """Genes that all filter entries let through, with what was resolved for them."""
    texts = expressions(entries)
    out = resolve_metadata(var, set().union(*map(columns_of, texts)), annotation) if texts else var
    for text in texts:
        out = out.where(predicate(text))
    return out


def filter_report(var: DataFrame, kept: DataFrame) -> DataFrame:
    """One row: genes before and after."""
    return var.agg(F.count("*").alias("n_input")).crossJoin(kept.agg(F.count("*").alias("n_retained")))
