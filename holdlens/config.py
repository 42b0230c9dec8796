"""Scoring configuration: defaults, YAML and look-ups."""

from __future__ import annotations

from dataclasses import dataclass, field, replace


@dataclass(frozen=True)
class Fund:
    ticker: str
    tier: str
    points: float


@dataclass(frozen=True)
class Sanitizer:
    blocked_tickers: tuple[str, ...] = ()
    blocked_name_exact: tuple[str, ...] = ()
    blocked_name_patterns: tuple[str, ...] = ()
    ticker_replacements: tuple[tuple[str, str], ...] = ()
    ticker_renames: tuple[tuple[str, str], ...] = ()


@dataclass(frozen=True)
class Config:
    sanitizer: Sanitizer = field(default_factory=Sanitizer)
    funds: tuple[Fund, ...] = ()
    rank_breakpoints: tuple[tuple[int, float], ...] = ((10, 1.5), (30, 1.2), (999, 1.0))
    new_lookback_days: int = 14
    new_bonus_mult: float = 5.0
    new_bonus_tiers: tuple[str, ...] = ("Scout", "Quant")
    high_conviction_min_etfs: int = 4
    delta_periods_days: tuple[int, ...] = (1, 7, 14, 30, 60, 90)
    rank_delta_lookback_days: int = 7
    leaderboard_lookback_days: int = 60
    changelog_top_n: int = 15
    quality_funds: tuple[str, ...] = ("COWZ", "CALF", "SPHQ")

    @property
    def tiers(self) -> list[str]:
        return list(dict.fromkeys(f.tier for f in self.funds))

    def fund_points(self) -> dict[str, float]:
        return {f.ticker: f.points for f in self.funds}

    def fund_tiers(self) -> dict[str, str]:
        return {f.ticker: f.tier for f in self.funds}

    def funds_in_tier(self, tier: str) -> list[str]:
        return [f.ticker for f in self.funds if f.tier == tier]

    @classmethod
    def from_yaml(cls, path: str) -> Config:
        import yaml

        with open(path, encoding="utf-8") as f:
            raw = yaml.safe_load(f) or {}
        s, h = raw.get("sanitizer") or {}, raw.get("history") or {}
        given = {
            "sanitizer": Sanitizer(
                *(tuple(map(str, s.get(k) or ())) for k in ("blocked_tickers", "blocked_name_exact", "blocked_name_patterns")),
                *(tuple((str(a), str(b)) for a, b in (s.get(k) or {}).items()) for k in ("ticker_replacements", "ticker_renames")),
            ),
            "funds": tuple(Fund(str(f["ticker"]), str(f["tier"]), float(f["points"])) for f in raw.get("etfs") or ()),
        }
        if "rank_breakpoints" in raw:
            given["rank_breakpoints"] = tuple((int(b["rank_max"]), float(b["multiplier"])) for b in raw["rank_breakpoints"])
        for source, names in ((raw, ("new_lookback_days", "new_bonus_mult", "new_bonus_tiers", "high_conviction_min_etfs")), (h, (
            "delta_periods_days", "rank_delta_lookback_days", "leaderboard_lookback_days", "changelog_top_n"))):
            given |= {k: tuple(source[k]) if isinstance(source[k], list) else source[k] for k in names if k in source}
        return replace(cls(), **given)


# fixed values: the fund universe and the clean-up lists that results depend on
DEFAULT = Config(
    sanitizer=Sanitizer(
        blocked_tickers=(
            "USD", "$USD", "$CAD", "$BRL", "$NOK", "$JPY", "$EUR", "$GBP", "$KRW", "$MXN", "$SAR", "$TWD", "$CNY", "Cash&Other", "AGPXX", "FGXXX", "USBFS03", "-",
        ),
        blocked_name_exact=(
            "Short-Term Investment Trust - Invesco Government & Agency Portfolio", "Invesco Government & Agency Portfolio", "Cash & Other", "Cash", "Other",
        ),
        blocked_name_patterns=("Money Market", "Securities Lending"),
        ticker_replacements=(("-", "."), ("/", "."), (" ", ".")),
        ticker_renames=(("GOOG", "GOOGL"),),
    ),
    funds=tuple(
        Fund(*f)
        for f in (
            ("CSD", "Scout", 40.0), ("FPX", "Scout", 40.0), ("QMOM", "Quant", 40.0), ("XMMO", "Quant", 40.0), ("XSMO", "Quant", 40.0), ("PIE", "Quant", 40.0),
            ("FPXI", "Scout", 60.0), ("IMOM", "Quant", 60.0), ("PDP", "Quant", 40.0), ("DWAS", "Quant", 40.0), ("EEMO", "Quant", 60.0), ("PIZ", "Quant", 60.0),
            ("COWZ", "Quality", 30.0), ("CALF", "Quality", 30.0), ("SPHQ", "Quality", 30.0), ("IVAL", "Quality", 30.0), ("SPMO", "Trend", 10.0),
            ("SPHB", "Trend", 10.0), ("RPG", "Trend", 10.0), ("XLG", "Blob", 2.0), ("QQQM", "Blob", 2.0),
        )
    ),
    leaderboard_lookback_days=120,
)
