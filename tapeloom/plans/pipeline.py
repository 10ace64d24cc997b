"""Fluent, immutable pipeline over bars: adjust, indicators, resample."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame

from ..operators.adjust import adjust
from ..operators.indicators import Indicator, create_indicator, is_registered
from ..operators.resample import resample


@dataclass(frozen=True)
class Pipeline:
    bars: DataFrame
    how: str | None = None
    steps: tuple[Indicator, ...] = field(default_factory=tuple)
    freqs: tuple[str, ...] = ()

    def adjust(self, how: str = "qfq") -> Pipeline:
        return replace(self, how=how)

    def indicators(self, *chosen: str | Indicator) -> Pipeline:
        """Registered names or indicators; unknown names are skipped."""
        made = [create_indicator(x) if isinstance(x, str) else x for x in chosen if not isinstance(x, str) or is_registered(x)]
        return replace(self, steps=(*self.steps, *made))

    def resample(self, *freqs: str) -> Pipeline:
        return replace(self, freqs=(*self.freqs, *freqs))

    def reset(self) -> Pipeline:
        return Pipeline(self.bars)

    def _indicated(self, bars: DataFrame) -> DataFrame:
        for step in self.steps:
            bars = step.apply(bars)
        return bars

    def _adjusted(self) -> DataFrame:
        return adjust(self.bars, self.how) if self.how else self.bars

    def run(self) -> DataFrame:
        """Adjusted bars with their indicators."""
        return self._indicated(self._adjusted())

    def run_with_resample(self) -> Mapping[str, DataFrame]:
        """``daily`` and each period's bars, indicators computed anew on each."""
        bars = self._adjusted()
        return {"daily": self._indicated(bars)} | {f: self._indicated(resample(bars, f, check_adjusted=self.how is not None)) for f in self.freqs}


def calculate_indicators(bars: DataFrame, names: Sequence[str], how: str | None = "qfq") -> DataFrame:
    """Ad hoc: adjust, then the known indicators."""
    p = Pipeline(bars)
    return (p.adjust(how) if how else p).indicators(*names).run()
