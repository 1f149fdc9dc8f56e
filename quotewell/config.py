"""Parameters of the pipeline. Operators take them as arguments; nothing below is read globally."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

# Label spellings to merge, scope lists, thresholds and model settings that the
# published results depend on.
STATE_ALIASES = {
    "Chattisgarh": "Chhattisgarh",
    "Jammu and Kashmir": "Jammu & Kashmir",
    "Tamilnadu": "Tamil Nadu",
    "Gao": "Goa",
    "Uttrakhand": "Uttarakhand",
}
ALL_COMMODITIES = ("Onion", "Potato", "Tomato", "Wheat")
MODEL_COMMODITIES = ("Onion", "Potato")
GAP_COMMODITIES = ("Tomato", "Wheat")
DROPPED_COMMODITY = "Rice"
REFERENCE_PRICES = {"wheat": 2425.0}
MODEL_FEATURES = (
    "lag_1", "lag_7", "lag_14", "lag_30",
    "rolling_mean_7", "rolling_std_7", "rolling_mean_30", "rolling_std_30",
    "month_sin", "month_cos", "day_of_week", "day_of_year",
    "commodity", "state",
)
EXCLUDED_FEATURES = ("price_vs_msp",)
CATEGORICAL_FEATURES = ("commodity", "state")
SEED = 42


@dataclass(frozen=True)
class TreeParams:
    """Boosted-tree settings: number of trees, depth, learning rate, histogram bins, seed."""

    n_trees: int = 300
    max_depth: int = 6
    learning_rate: float = 0.05
    max_bins: int = 256
    seed: int = SEED

    def as_dict(self) -> dict[str, str]:
        return {name: str(value) for name, value in vars(self).items()}


@dataclass(frozen=True)
class PanelConfig:
    """Column names and knobs shared by all stages."""

    state: str = "state"
    market: str = "market_name"
    commodity: str = "commodity"
    date: str = "price_date"
    price: str = "modal_price"
    low_price: str = "min_price"
    high_price: str = "max_price"

    # First fit wins. Formats with a month name (MMM) see the text with single blanks between its
    # parts; those without are not tried on a text that has letters.
    date_formats: tuple[str, ...] = (
        "yyyy-M-d", "M/d/yyyy", "M-d-yyyy", "yyyy/M/d", "yyyyMMdd", "yyyy.M.d", "M/d/yy", "M-d-yy",
        "d MMM yyyy", "d MMMM yyyy", "MMM d yyyy", "MMMM d yyyy", "yyyy MMM d", "yyyy MMMM d",
        "d MMM yy", "d MMMM yy",
    )
    state_aliases: dict[str, str] = field(default_factory=lambda: dict(STATE_ALIASES))
    dropped_commodity: str = DROPPED_COMMODITY
    lower_iqr_factor: float = 1.5
    upper_iqr_factor: float = 3.0

    lags: tuple[int, ...] = (1, 7, 14, 30)
    windows: tuple[int, ...] = (7, 30)
    min_periods: int = 3
    reference_prices: dict[str, float] = field(default_factory=lambda: dict(REFERENCE_PRICES))

    all_commodities: tuple[str, ...] = ALL_COMMODITIES
    scope: tuple[str, ...] = MODEL_COMMODITIES
    gap_commodities: tuple[str, ...] = GAP_COMMODITIES
    train_ratio: float = 0.80
    model_features: tuple[str, ...] = MODEL_FEATURES
    categorical_features: tuple[str, ...] = CATEGORICAL_FEATURES

    season_months: tuple[int, ...] = (1, 2, 3, 4, 5, 6)
    expected_years: tuple[int, int] = (2023, 2025)
    market_ballpark_pct: float = 17.0
    state_ballpark_pct: float = 40.0
    ballpark_tolerance: float = 10.0
    viable_pct: float = 30.0
    plausible_price_limit: float = 1_000_000.0
    tolerance: float = 1e-6
    seed: int = SEED

    @property
    def keys(self) -> list[str]:
        return [self.state, self.commodity]

    @property
    def price_columns(self) -> list[str]:
        return [self.low_price, self.high_price, self.price]

    def with_changes(self, **changes) -> PanelConfig:
        return replace(self, **changes)
