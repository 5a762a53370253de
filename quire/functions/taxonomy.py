"""The category taxonomy as data (U2): names, display icons and match keywords.

A taxonomy is a parameter of every operator that uses one (``DEFAULT`` unless given).
It is configuration, never derived from the data, so it is rendered into plans and prompts
as literals.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

# Category names (in display order) and their icons; the last one is the
# domain-flag category, whose name is ours.
CATEGORIES = [
    ("AI & ML", "🤖"),
    ("Funding & Deals", "💰"),
    ("Market Trends", "📈"),
    ("Legal Tech", "⚖️"),
    ("Product Launches", "🚀"),
    ("Policy & Regulation", "📜"),
    ("Domain-Relevant", "🎯"),
]
DEFAULT_ICON = "📌"
SUMMARY_ICON = "📋"
FLAG_ICON = "⚡"
SOURCE_ICON = "📰"
FACT_ICON = "📌"
LINK_ICON = "🔗"
NOTICE_ICON = "⚠️"
TITLE_ICON = "📬"
DOMAIN_CATEGORY = "Domain-Relevant"

# Our own keyword lists for the extractive stand-in of the model (lower case).
KEYWORDS = {
    "AI & ML": ["ai", "model", "models", "learning", "neural", "data", "algorithm", "intelligence"],
    "Funding & Deals": ["funding", "raised", "round", "deal", "deals", "investor", "acquisition", "$"],
    "Market Trends": ["market", "markets", "trend", "growth", "demand", "price", "prices", "percent"],
    "Legal Tech": ["legal", "law", "court", "litigation", "attorney", "contract", "lawyer", "license",
                   "licensed", "copyright"],
    "Product Launches": ["launch", "launched", "release", "released", "product", "new", "version"],
    "Policy & Regulation": ["policy", "regulation", "rule", "rules", "government", "compliance", "act"],
    "Domain-Relevant": ["tort", "class", "medical", "record", "records", "health", "healthcare"],
}
# Our own domain-flag keywords.
FLAG_KEYWORDS = ["legal", "litigation", "tort", "class", "medical", "health", "court", "license",
                 "licensed", "rights"]


@dataclass(frozen=True)
class Taxonomy:
    categories: tuple[tuple[str, str], ...]              # (name, icon), in display order
    keywords: tuple[tuple[str, tuple[str, ...]], ...]    # (name, match words)
    flag_keywords: tuple[str, ...] = ()
    domain_category: str = DOMAIN_CATEGORY
    default_icon: str = DEFAULT_ICON

    def names(self) -> list[str]:
        return [n for n, _ in self.categories]

    def icon(self, name: str) -> str:
        return dict(self.categories).get(name, self.default_icon)

    def words(self, name: str) -> list[str]:
        return list(dict(self.keywords).get(name, ()))

    def bullets_text(self) -> str:
        """Bulleted category list for the prompt."""
        return "\n   ".join(f"- {n}" for n in self.names())

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [(i, n, icon, self.words(n)) for i, (n, icon) in enumerate(self.categories, 1)]
        return spark.createDataFrame(rows, "cat_pos INT, name STRING, icon STRING, keywords ARRAY<STRING>")


DEFAULT = Taxonomy(tuple(CATEGORIES), tuple((n, tuple(k)) for n, k in KEYWORDS.items()), tuple(FLAG_KEYWORDS))
