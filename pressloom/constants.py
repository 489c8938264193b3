"""Fixed values of the digest job: the texts and limits every run relies on."""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Keyword groups (each group is an OR of phrases), in group order.
# ---------------------------------------------------------------------------
KEYWORD_GROUPS: tuple[tuple[str, ...], ...] = (
    ("paint booth", "spray booth", "coating booth"),
    ("industrial coating", "powder coating", "surface finishing"),
    ("automotive painting", "automotive coating", "paint shop"),
    ("paint technology", "coating technology", "painting equipment"),
    ("paint VOC", "coating regulation", "paint emission"),
)

# Hosts never searched.
EXCLUDED_DOMAINS: tuple[str, ...] = (
    "youtube.com",
    "tiktok.com",
    "reddit.com",
    "facebook.com",
    "instagram.com",
    "twitter.com",
    "x.com",
    "pinterest.com",
)

# Categories in report order, key -> label.  The last one is the default.
CATEGORIES: tuple[tuple[str, str], ...] = (
    ("equipment", "塗装設備"),
    ("technology", "塗装技術"),
    ("automotive", "自動車塗装"),
    ("regulation", "環境規制"),
    ("market", "市場動向"),
    ("company", "企業ニュース"),
    ("other", "その他"),
)
DEFAULT_CATEGORY = "other"

# Limits.
ARTICLES_PER_GROUP = 10
ARTICLES_PER_ISSUE = 20
SEARCH_DAYS = 7
MAX_ATTEMPTS = 3
PREVIEW_TITLES = 5
TITLE_SIMILARITY = 0.75

# Texts.
UNKNOWN_SOURCE = "Unknown"
REMOVED_MARKER = "[removed]"
SUMMARY_MISSING = "（要約なし）"
SUMMARY_FAILED = "（翻訳に失敗しました）"
CATEGORY_SEPARATOR = " ｜ "
ISSUE_PREFIX = "weekly-news-"

# Fixed value: the report calendar runs at UTC+9 all year.
REPORT_UTC_OFFSET_HOURS = 9
