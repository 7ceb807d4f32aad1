"""Settings of the report job. Defaults are those of the December report."""

from __future__ import annotations

import json
from dataclasses import dataclass, field, fields, replace
from pathlib import Path


def _naming_rules(month: str) -> list[dict]:
    return [
        {
            "id": "force_item_agg",
            "stage": "pre",
            "type": "set_colname",
            "col_idx": 0,
            "value": "item_agg",
            "when": {"op": "always"},
        },
        {
            "id": f"col1_if_{month}_or_ytd",
            "stage": "pre",
            "type": "set_colname",
            "col_idx": 1,
            "value": "item_agg_2",
            "when": {"op": "col_segment_in", "tokens": [month, "ytd"]},
        },
    ]


def _header_tokens(month: str) -> list[str]:
    # The words a header row may hold.
    return [
        "vs", "act", "bdg", "eur", "%", "pct", "ytd", "month", "euro/000", "2024", "2025", month,
    ]


# Sub-chapters and their page ranges, in order; later ranges win.
CHAPTERS = {
    "OVERVIEW": {"OVERVIEW": (0, 3)},
    "PHARMA": {
        "OVERVIEW": (4, 10),
        "WESTERN_EUROPE": (11, 20),
        "CENTRAL_EASTERN_EUROPE": (21, 27),
        "ASIA_PACIFIC": (28, 41),
        "TURKEY_AFRICA_MIDDLE_EAST": (42, 49),
        "LATAM_CENTRAL_AMERICA": (50, 57),
        "PRODUCTS": (58, 61),
    },
    "ONCOLOGY": {"OVERVIEW": (62, 65)},
    "DIAGNOSTIC": {"OVERVIEW": (66, 71)},
    "CELL_BIOLOGY": {"OVERVIEW": (62, 65)},
}

# The columns of the fact table, in order.
FINAL_COLUMNS = [
    "page_num", "capitolo", "sottocapitolo", "page_title", "page_subtitle", "page_subtitle_1",
    "table_id", "period_desc", "period_start", "item_agg_2", "item_agg_1", "item_agg",
    "2024_act", "2025_act", "2025_bdg", "eur_vs_act", "pct_vs_act", "eur_vs_bdg", "pct_vs_bdg",
    "eur_delta", "pct_delta", "run_id", "timestamp_utc",
]


@dataclass(frozen=True)
class ReportConfig:
    header_tokens: list[str] = field(default_factory=lambda: _header_tokens("december"))
    header_rules: list[dict] = field(default_factory=lambda: _naming_rules("december"))
    period_placeholder: str | None = None
    period_tokens: list[str] = field(default_factory=lambda: ["december", "ytd"])
    period_min_hits: int = 2
    max_title_rows: int = 1
    drop_title_rows: bool = True
    title_empty_threshold: float = 0.5
    split_empty_threshold: float = 0.85
    confirm_header: bool = True
    keywords_primary: list[str] = field(default_factory=lambda: ["TOTAL", "GRAND_TOTAL"])
    keywords_fallback: list[str] = field(default_factory=lambda: ["December", "YTD"])
    max_lookahead: int = 2
    min_rows_per_table: int = 5
    slicer_header_rows: list[int] = field(default_factory=lambda: [0, 1])
    slicer_thresholds: list[float] = field(default_factory=lambda: [0.60, 0.95])
    aggregation_keywords: list[str] = field(
        default_factory=lambda: [
            "Pharma", "Oncology", "Diagnostic", "Other Business", "TOTAL GROUP",
        ]
    )
    static_columns: list[str] = field(
        default_factory=lambda: [
            "page_num", "page_title", "page_subtitle", "page_subtitle_1", "table_id",
            "period_agg", "period_start", "item_agg_1",
        ]
    )
    audit_columns: list[str] = field(default_factory=lambda: ["run_id", "timestamp_utc"])
    bad_tokens: list[str] | None = None
    preview_limit: int = 8
    percent_threshold: float = 0.5
    percent_max_loss: float = 0.1
    numeric_threshold: float = 0.5
    numeric_max_loss: float = 0.1
    typing_exclude: list[str] = field(default_factory=list)
    chapters: dict = field(default_factory=lambda: CHAPTERS)
    year_ref: int = 2025
    final_columns: list[str] = field(default_factory=lambda: list(FINAL_COLUMNS))
    fallback_keep_data: bool = False
    bucket_rows: int = 1024

    def rules(self) -> list[dict]:
        """All naming rules, the period placeholder as the last one."""
        extra = []
        if self.period_placeholder:
            extra.append(
                {
                    "id": "period_placeholder",
                    "stage": "post",
                    "type": "replace_segment",
                    "tokens": list(self.period_tokens),
                    "placeholder": self.period_placeholder,
                    "min_hits": self.period_min_hits,
                }
            )
        return [*self.header_rules, *extra]

    @classmethod
    def december(cls, **changes) -> ReportConfig:
        return cls(**changes)

    @classmethod
    def january(cls, **changes) -> ReportConfig:
        month = {
            "header_tokens": _header_tokens("january"),
            "header_rules": _naming_rules("january"),
            "period_tokens": ["january", "ytd"],
            "keywords_fallback": ["january", "YTD"],
        }
        return cls(**{**month, **changes})

    def with_name_overrides(self, overrides: dict[int, str]) -> ReportConfig:
        """Adds fixed names by column position, applied after the other rules of that stage."""
        extra = [
            {"stage": "pre", "type": "set_colname", "col_idx": i, "value": v}
            for i, v in overrides.items()
        ]
        return replace(self, header_rules=[*self.header_rules, *extra])

    @classmethod
    def from_json(cls, path: str | Path) -> ReportConfig:
        """Reads the nested settings file of a report."""
        return cls.from_dict(json.loads(Path(path).read_text(encoding="utf-8")))

    @classmethod
    def from_dict(cls, raw: dict) -> ReportConfig:
        nested = {
            ("title", "max_title_rows"): "max_title_rows",
            ("title", "drop_row"): "drop_title_rows",
            ("split", "empty_threshold"): "split_empty_threshold",
            ("split", "confirm_header"): "confirm_header",
            ("split", "keywords_primary"): "keywords_primary",
            ("split", "keywords_fallback"): "keywords_fallback",
            ("slicer", "header_rows"): "slicer_header_rows",
            ("slicer", "sim_thresholds"): "slicer_thresholds",
            ("dataquality", "preview_limit"): "preview_limit",
            ("cleaning", "percent_threshold"): "percent_threshold",
            ("cleaning", "percent_max_loss_ratio"): "percent_max_loss",
            ("cleaning", "numeric_pre_scan_threshold"): "numeric_threshold",
            ("cleaning", "numeric_max_loss_ratio"): "numeric_max_loss",
        }
        renamed = {
            "static_column_list": "static_columns",
            "audit_column_list": "audit_columns",
        }
        known = {f.name for f in fields(cls)}
        values = {renamed.get(k, k): v for k, v in raw.items() if renamed.get(k, k) in known}
        for (section, key), name in nested.items():
            if key in raw.get(section, {}):
                values[name] = raw[section][key]
        if "capitoli" in raw:
            values["chapters"] = {
                chapter: {sub: tuple(pages) for sub, pages in body["sottocapitoli"].items()}
                for chapter, body in raw["capitoli"].items()
            }
        return cls(**values)
