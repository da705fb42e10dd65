"""Record schemas and settings."""

from __future__ import annotations

from dataclasses import dataclass, field, fields
from pathlib import Path

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A log record in the common shape; records of any source are a subset of its fields.
LOG_SCHEMA = "`@timestamp` string, message string, log struct<level:string, logger:string>, event struct<id:string, dataset:string, reason:string>, host struct<name:string>"
#: A parsed record: fields found at run time are a map from dotted path to value, which only the sink nests.
PARSED_SCHEMA = LOG_SCHEMA + ", parsed_template string, extracted map<string,string>"
TRUTH_SCHEMA = "LineId string, Content string, EventTemplate string"
PROFILE_SCHEMA = (
    "time_taken_seconds double, llm_invocations long, prompt_tokens long, completion_tokens long, total_tokens long, llm_timeouts long, "
    "failed_invocations long, cache_hits long, log_volume long, history array<struct<log_volume:long, llm_invocations:long, cache_hits:long>>, model_used string, method_used string"
)


def dataset_key(record_id: Column | str) -> Column:
    """What stands before the first underscore of an id, else `default`."""
    c = F.col(record_id) if isinstance(record_id, str) else record_id
    return F.when(F.instr(c, "_") > 0, F.substring_index(c, "_", 1)).otherwise(F.lit("default"))


@dataclass(frozen=True)
class RouterSettings:
    """Dictionary routing: the prefix tree, the loose match and the merging of templates."""

    loose_match_threshold: float = 0.8
    loose_match_metric: str = "positional_decay"
    decay: float = 0.15
    merge_threshold: float = 0.95
    merge_mode: str = "production"
    merge_prefilter: float = 0.3
    prompt_mode: str = "production"
    match_mode: str = "production"
    capacity: int = 1000
    max_age_days: int = 30
    calibrate_every: int = 1000
    k_shots: int = 3
    shot_selection: str = "similarity"
    categories: str = "ecs_3"


@dataclass(frozen=True)
class BatchSettings:
    """Micro-batched clustering."""

    batch_size: int = 10
    buffer_size: int = 500
    buffer_max_age_s: float = 5.0
    similarity_threshold: float = 0.8
    clusterer: str = "LengthCluster"
    vectorizer: str = "binary"
    sampler: str = "DPPSampler"
    dpp_pool: int = 100
    cache_size: int = 5000
    noise_retries: int = 2
    dynamic_eps: bool = False
    noise_mode: str = "production"
    cache_mode: str = "production"
    postprocess_mode: str = "production"
    prompt_mode: str = "production"
    similar_sampler_mode: str = "production"
    dpp_kernel_mode: str = "production"
    batch_truncation_mode: str = "production"
    embedding_length: int | None = 4000
    history_cap: int | None = 100


@dataclass(frozen=True)
class TreeSettings:
    """Tree grouping with regex memory."""

    similarity: str = "jaccard"
    sample_size: int = 3
    max_sample_logs: int = 200
    reflection: bool = True
    memory_mode: str = "original"
    max_memory: int | None = None


@dataclass(frozen=True)
class Settings:
    router: RouterSettings = field(default_factory=RouterSettings)
    batch: BatchSettings = field(default_factory=BatchSettings)
    tree: TreeSettings = field(default_factory=TreeSettings)

    @classmethod
    def from_dict(cls, values: dict) -> Settings:
        """Unknown keys are left alone, missing ones keep their defaults."""
        made = {}
        for f in fields(cls):
            kind = f.default_factory
            known = {x.name for x in fields(kind)}
            made[f.name] = kind(**{k: v for k, v in (values.get(f.name) or {}).items() if k in known})
        return cls(**made)


#: What long-running deployments use instead of the defaults.
PRESET_LARGE = {
    "router": {"loose_match_metric": "positional_uniform"},
    "batch": {"batch_size": 5, "buffer_size": 10_000, "clusterer": "SimilarityCluster", "vectorizer": "tfidf"},
}


def load_settings(path: str | None = None, fallback: str | None = None, env: dict[str, str] | None = None, prefix: str = "LOGRAIL_") -> Settings:
    """Settings of a YAML file: of `path`, of `fallback` if that is missing, or the defaults if there is neither.

    Variables of `env` (a process's environment) named by prefix, section and name, LOGRAIL_BATCH_SAMPLER say, win over the file.
    """
    values: dict = {}
    for p in (path, fallback):
        if p and Path(p).exists():
            import yaml

            values = yaml.safe_load(Path(p).read_text(encoding="utf-8")) or {}
            break
    for f in fields(Settings):
        for x in fields(f.default_factory):
            text = (env or {}).get(f"{prefix}{f.name}_{x.name}".upper())
            if text is not None:
                values[f.name] = {**(values.get(f.name) or {}), x.name: _parsed(text, x.default)}
    return Settings.from_dict(values)


def _parsed(text: str, default):
    """A variable's text as the kind of value that a setting has; an empty one is none."""
    if text == "":
        return None
    if isinstance(default, bool):
        return text.strip().lower() in ("1", "true", "yes")
    return type(default)(text) if isinstance(default, (int, float)) else int(text) if default is None and text.lstrip("-").isdigit() else text
