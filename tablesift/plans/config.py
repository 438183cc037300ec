"""Named configurations of the curation pipeline."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, replace


@dataclass(frozen=True)
class Config:
    """What to keep.  None switches a check off.

    ``table_quality_position`` says whether the quality model is asked before
    columns and rows are filtered ("pre") or after ("post"); without a model
    path that check is left out after, and is an error before.
    """

    min_rows: int | None = 100
    max_rows: int | None = None
    min_cols: int | None = 6
    max_cols: int | None = 512
    filter_too_many_columns: bool = False
    min_dtypes: int | None = None
    max_header_len_chars: int | None = 256
    min_unique_column_values: int = 2
    max_null_like_frac: float | None = None
    max_frac_numeric_colnames: float | None = 0.1
    max_frac_unnamed_colnames: float | None = None
    code_detect_threshold: float | None = None
    pii_detect_threshold: float | None = None
    strict_pii_threshold: bool = False
    langdetect_threshold: float = 0.5
    drop_invalid_cols: bool = False
    drop_extra_cols: bool = False
    max_value_len_chars: int | None = 14336
    filter_substrings: tuple[str, ...] | None = ("@@@", "###", "└─")
    filter_code_rows: bool = True
    filter_pii_rows: bool = True
    drop_duplicate_rows: bool = True
    max_output_rows: int | None = 1000
    table_quality_threshold: float | None = None
    table_quality_position: str = "post"
    table_quality_model: str | None = None

    def __post_init__(self) -> None:
        if self.table_quality_position not in ("pre", "post"):
            raise ValueError("table_quality_position is 'pre' or 'post'")
        if isinstance(self.filter_substrings, str):
            raise ValueError("filter_substrings is a tuple of strings")
        for name in ("max_null_like_frac", "max_frac_numeric_colnames", "max_frac_unnamed_colnames", "code_detect_threshold", "pii_detect_threshold", "langdetect_threshold"):
            value = getattr(self, name)
            if value is not None and not 0 <= value <= 1:
                raise ValueError(f"{name} is a share")

    def to_json(self, path: str | None = None) -> str:
        text = json.dumps(asdict(self), indent=4, sort_keys=True, ensure_ascii=False)
        if path:
            with open(path, "w") as out:
                out.write(text)
        return text


_NO_ROW_CHECKS = {"filter_substrings": None, "filter_code_rows": False, "filter_pii_rows": False, "drop_duplicate_rows": False}
_V6 = Config(min_rows=64, max_null_like_frac=0.1, drop_extra_cols=True, drop_invalid_cols=True, pii_detect_threshold=0.05, code_detect_threshold=0.05, max_frac_unnamed_colnames=0.5)

# Thresholds of the quality model by version.
_AFTER = {
    "v8": 0.0055, "v8.1": 0.01, "v8.2": 0.02, "v8.3": 0.04,
    "v9.0.1": 0.00137736471369862, "v9.1.1": 0.00037273640627972766, "v9.2.1": 0.004433658253401516,
    "v9.3": 0.008328398689627647, "v9.4": 0.0005960157141089435, "v9.5": 0.0002231991820735857,
}

VERSIONS: dict[str, Config] = {
    "v3": Config(max_header_len_chars=None, max_frac_numeric_colnames=None, filter_too_many_columns=True, **_NO_ROW_CHECKS),
    "v5": Config(max_null_like_frac=0.1, drop_extra_cols=True, drop_invalid_cols=True, **_NO_ROW_CHECKS),
    "v6": _V6,
    "v7": replace(_V6, table_quality_threshold=0.0055, table_quality_position="pre"),
    **{name: replace(_V6, table_quality_threshold=value) for name, value in _AFTER.items()},
    "baseline": Config(
        min_rows=1, min_cols=1, max_cols=2048, max_header_len_chars=4096, min_unique_column_values=1, max_frac_numeric_colnames=1.0, max_frac_unnamed_colnames=1.0, langdetect_threshold=0.0,
        max_value_len_chars=None, filter_code_rows=False, filter_pii_rows=False, drop_duplicate_rows=False, max_output_rows=None,
    ),
}


def config(version: str, **changes) -> Config:
    if version not in VERSIONS:
        raise ValueError(f"no version {version!r}; there are {', '.join(VERSIONS)}")
    return replace(VERSIONS[version], **changes)
