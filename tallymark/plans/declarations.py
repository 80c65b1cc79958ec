"""The lazy plan from declarations to residuals; each step is a DataFrame of the one before.

Declarations are shuffled once for the pairs: sides, canonical rows and ids all come from one
aggregate on the mirror key. Only steps that need every matched row (matched, paired) join the ids
back to the rows. The concordance is a dimension, written once for each version of its edges."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame

from tallymark.config import Config
from tallymark.functions.codes import normalise_code
from tallymark.operators import canonical, cascade, concordance, pairing, residual
from tallymark.schema import without_nan
from tallymark.session import materialise
from tallymark.sources import dims


class Plan:
    """tables(name) gives a dimension table when a step first needs it: factors, conversion, entrepots,
    reporters, and edges (None: codes are only normalised, not carried to another revision).

    NaN is null from the first step on. Rows that repeat another of their source are dropped (the lowest
    id stays), unless that was done before. source: the columns that tell sources of rows apart."""

    def __init__(self, declarations: DataFrame, cfg: Config, tables: Callable[[str], DataFrame | None], source: tuple[str, ...] = ("load_no",), repeats: bool = False):
        self.declarations, self.cfg, self._tables, self.source, self.repeats = declarations, cfg, tables, source, repeats

    @cached_property
    def edges(self) -> DataFrame | None:
        return self._tables("edges")

    @cached_property
    def factors(self) -> DataFrame:
        return dims.uplift_factors(self._tables("factors"))

    @cached_property
    def conversion(self) -> DataFrame:
        return dims.conversions(self._tables("conversion"))

    @cached_property
    def entrepots(self) -> DataFrame:
        return dims.entrepots(self._tables("entrepots"))

    @cached_property
    def reporters(self) -> DataFrame:
        return dims.reporters(self._tables("reporters"))

    @cached_property
    def passed(self) -> DataFrame:
        """Rows that pass all filters, repeats included."""
        kept = cascade.survivors(without_nan(self.declarations), self.cfg)
        return kept.filter(kept.reporterCode.isin(*self.cfg.reporters)) if self.cfg.reporters is not None else kept

    @cached_property
    def survivors(self) -> DataFrame:
        return self.passed if self.repeats else cascade.drop_duplicates(self.passed, [*self.source, "refYear"])

    @cached_property
    def concordance(self) -> DataFrame:
        return concordance.compose(materialise(concordance.normalise_weights(self.edges)), self.cfg.canonical_revision)

    @cached_property
    def best_codes(self) -> DataFrame:
        """A dimension of a few thousand codes, built once: its chain of joins is no part of later plans."""
        made = self._tables("best_codes")
        return materialise(concordance.best_targets(self.concordance, self.cfg.canonical_revision)) if made is None else made

    @cached_property
    def canonical_codes(self) -> DataFrame:
        return concordance.canonicalise(self.survivors, self.best_codes, self.cfg.canonical_revision)

    @cached_property
    def keyed(self) -> DataFrame:
        if self.edges is None and self._tables("best_codes") is None:
            return pairing.with_mirror_key(self.survivors.withColumn("canonical_cmd", normalise_code(self.survivors.cmdCode)), null_keys_match=self.cfg.null_keys_match)
        return pairing.with_mirror_key(self.canonical_codes, null_keys_match=self.cfg.null_keys_match)

    @cached_property
    def groups(self) -> DataFrame:
        return pairing.groups(self.keyed)

    @cached_property
    def numbered(self) -> DataFrame:
        """The matched groups with their ids."""
        return pairing.number(pairing.matched_groups(self.groups), "first_x", "matched_id")

    @cached_property
    def paired(self) -> DataFrame:
        return pairing.attach(self.keyed, self.numbered)

    @cached_property
    def matched(self) -> DataFrame:
        """All rows of matched groups."""
        return self.keyed.drop("matched_id").join(self.numbered.select(*pairing.KEY, "matched_id"), list(pairing.KEY))

    @cached_property
    def dominant(self) -> DataFrame:
        return canonical.dominant(self.numbered)

    @cached_property
    def clean(self) -> DataFrame:
        columns = [c for c in self.survivors.columns if c != "matched_id"]
        rows = [canonical.row_of(columns, f).alias(n) for f, n in (("X", "_x"), ("M", "_m"))]
        whole = pairing.matched_groups(pairing.groups(self.keyed, *rows)).select("first_x", "_x", "_m")
        return canonical.clean_of_groups(pairing.number(whole, "first_x", "matched_id"))

    @cached_property
    def uplifted(self) -> DataFrame:
        return residual.with_uplift(self.clean, self.factors, self.cfg.default_uplift)

    @cached_property
    def residuals(self) -> DataFrame:
        return residual.residuals(self.uplifted, self.conversion)
