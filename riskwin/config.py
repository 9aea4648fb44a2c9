"""Run parameters and the fixed values that results depend on."""

from __future__ import annotations

from dataclasses import dataclass

# --- fixed values (must equal the original job's for equal results) ---------
# rolling window length in records, overrun threshold, portfolio label
WINDOW_SIZE = 30
OVERRUN_THRESHOLD = 0.01
PORTFOLIO = "full_portfolio"
# the five statistics, in the order the 35 flags are laid out
STATS = ("mean", "median", "tenth", "tail_mean", "safety")
# batch median is rounded to this many decimal places
BATCH_MEDIAN_DIGITS = 4
# share of the ordered sample used by the tenth quantile and the tail mean
TAIL_SHARE = 0.1


@dataclass(frozen=True)
class RiskParams:
    """Knobs of one monitoring run.

    ``median``: ``"reference"`` picks elements ``W//2`` and ``W//2+1`` of the
    sorted window (0-based); ``"true"`` the textbook middle pair/element.
    ``quantile_index``: ``"reference"`` uses element ``int(0.1*W)`` of the
    window; ``"disc"`` the rank ``ceil(0.1*W)`` (same rule as the batch side).
    ``safety_divisor``: ``"history"`` divides the window's absolute deviation
    by twice the full-history count (original behaviour); ``"window"`` by twice
    the window length.
    ``block_rows``: records per window block (halo blocks); must be >= W-1.
    ``engine``: how window statistics are computed once Spark has formed
    the halo blocks: ``"blocks"`` reduces a block's batches with numpy inside
    ``applyInArrow`` (vectorised, the default); ``"native"`` uses array
    expressions over ``collect_list`` frames (no Python workers).
    ``ranks``: full-history quantiles are ``"exact"``, or ``"approx"`` as the
    sketch gives them, in one pass, with a rank error of at most 1 /
    ``approx_accuracy`` of the values.
    ``approx_accuracy``: accuracy of the sketch; with exact ranks it changes the
    number of candidates, never a result.
    """

    window: int = WINDOW_SIZE
    threshold: float = OVERRUN_THRESHOLD
    median: str = "reference"
    quantile_index: str = "reference"
    safety_divisor: str = "history"
    block_rows: int = 200_000
    engine: str = "blocks"
    approx_accuracy: int = 20_000
    ranks: str = "exact"

    def __post_init__(self) -> None:
        if self.window < 1:
            raise ValueError("window must be >= 1")
        if self.block_rows < max(1, self.window - 1):
            raise ValueError("block_rows must be >= window - 1")
        if self.median not in ("reference", "true"):
            raise ValueError("median must be 'reference' or 'true'")
        if self.quantile_index not in ("reference", "disc"):
            raise ValueError("quantile_index must be 'reference' or 'disc'")
        if self.ranks not in ("exact", "approx"):
            raise ValueError("ranks must be 'exact' or 'approx'")
        if self.engine not in ("blocks", "native"):
            raise ValueError("engine must be 'blocks' or 'native'")
        if self.safety_divisor not in ("history", "window"):
            raise ValueError("safety_divisor must be 'history' or 'window'")
