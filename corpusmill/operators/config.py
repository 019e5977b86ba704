"""Site and language configuration: merging, defaults, resolution, detection of site families. Plain data on the driver."""

from __future__ import annotations

from collections.abc import Mapping
from copy import deepcopy
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULTS: dict[str, Any] = {"default_language": None, "noise_language": [], "amp_mode": "none", "verify_ssl": True, "article_url_filters": [], "article_url_excludes": [], "author_strategy": [], "category_strategy": []}


def merged(base: Mapping, over: Mapping) -> dict:
    """Mappings merge key by key, lists are joined, anything else is replaced, by null too."""
    out = deepcopy(dict(base))
    for key, value in over.items():
        if isinstance(value, Mapping) and isinstance(out.get(key), Mapping):
            out[key] = merged(out[key], value)
        elif isinstance(value, list) and isinstance(out.get(key), list):
            out[key] = out[key] + deepcopy(value)
        else:
            out[key] = deepcopy(value)
    return out


def as_list(value: Any) -> list:
    """A value as a list of stripped, filled entries."""
    found = [] if value is None else list(value) if isinstance(value, (list, tuple)) else [value]
    return [x.strip() if isinstance(x, str) else x for x in found if x not in (None, "") and not (isinstance(x, str) and not x.strip())]


def selectors(site: Mapping, defaults: Mapping) -> dict[str, list]:
    """Selector chains: the site's first, then the defaults, each once. A site's strategy lists replace the default ones."""
    out = {}
    for key in {*site, *defaults}:
        if key.endswith("_selectors"):
            out[key] = list(dict.fromkeys([*as_list(site.get(key)), *as_list(defaults.get(key))]))
        elif key.endswith("_strategy"):
            out[key] = as_list(site.get(key)) or as_list(defaults.get(key))
    return out


def noise_words(site: Mapping, languages: Mapping, legacy: Mapping | None = None) -> list[str]:
    """The union of the packages that a site's noise_language names; a package that is not there gives the legacy list."""
    found: dict[str, None] = {}
    for name in as_list(site.get("noise_language")):
        package = languages.get(name)
        words = package.get("noise_words", []) if package else (legacy or {}).get(name, [])
        found.update(dict.fromkeys(as_list(words)))
    return list(found)


def resolve(config: Mapping, key: str) -> dict:
    """A site's settings: defaults, the global ones, its own; with selector chains, noise words, author patterns and date locale."""
    site = config.get("sites", {}).get(key, {})
    out = merged(merged(DEFAULTS, config.get("defaults", {})), site)
    out |= selectors(site, config.get("defaults", {}))
    languages = config.get("languages", {})
    package = languages.get(out.get("default_language") or "", {})
    return out | {
        "site_key": key,
        "noise_words": noise_words(out, languages),
        "author_patterns": as_list(site.get("author_regex")) or as_list(package.get("author_regex")),
        "date_locale": site.get("date_locale") or package.get("date_locale") or {},
    }


def site_patterns(spark: SparkSession, config: Mapping) -> DataFrame:
    """(pattern, site): host patterns of all sites, for a broadcast join."""
    rows = [(p.lower(), k) for k, s in config.get("sites", {}).items() for p in as_list(s.get("match"))]
    return spark.createDataFrame(rows, "pattern string, site string")


def family(html: Column, families: Mapping[str, Mapping]) -> Column:
    """The family whose indicators, weighted, reach its least score; the best, ties to the first; null if none does."""
    scored = []
    for i, (name, f) in enumerate(families.items()):
        total = sum((F.when(html.contains(part), float(w)).otherwise(0.0) for part, w in f["indicators"].items()), F.lit(0.0))
        scored.append(F.when(total >= float(f["min_score"]), F.struct(total.alias("score"), F.lit(-i).alias("order"), F.lit(name).alias("name"))))
    return F.greatest(*scored)["name"] if len(scored) > 1 else scored[0]["name"]


def load(path: str) -> dict:
    """A YAML file; files that it includes are merged first, in order."""
    from pathlib import Path

    import yaml

    here = Path(path)
    own = yaml.safe_load(here.read_text(encoding="utf-8")) or {} if here.exists() else {}
    out: dict = {}
    for name in own.pop("includes", []):
        out = merged(out, load(str(here.parent / name)))
    return merged(out, own)
