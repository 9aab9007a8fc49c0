"""Configuration: nested lookups, the lake and topic sections, and S3A settings of a warehouse."""

from __future__ import annotations

import logging
import re
from collections.abc import Mapping
from dataclasses import dataclass, field, fields
from typing import Any

log = logging.getLogger(__name__)
REQUIRED = object()
_INT = re.compile(r"[+-]?[0-9]+")


class ConfigError(ValueError):
    """A setting is missing or can't be read."""


def lookup(config: Mapping | None, path: str | None) -> Any:
    """The value at a dotted path; None where the path ends early or is empty. A step into what is no map is an error."""
    if config is None or not path:
        return None
    here: Any = config
    for step in path.split("."):
        if not isinstance(here, Mapping):
            raise ConfigError(f"'{path}' leads through a value that is no map")
        here = here.get(step)
        if here is None:
            return None
    return here


def _or_default(read, config: Mapping | None, path: str, default: Any) -> Any:
    """What ``read`` makes of the value; with a default, that also stands for values that can't be read."""
    try:
        value = lookup(config, path)
        if value is None:
            raise ConfigError(f"setting '{path}' is required")
        return read(value, path)
    except ConfigError:
        if default is REQUIRED:
            raise
        return default


def parse_int(value: Any, path: str) -> int:
    if isinstance(value, int) and not isinstance(value, bool):
        return value
    if not _INT.fullmatch(str(value)):
        raise ConfigError(f"setting '{path}' is no integer: {value}")
    return int(str(value))


def get_string(config: Mapping | None, path: str, default: Any = REQUIRED) -> str:
    return _or_default(lambda v, _: str(v), config, path, default)


def get_integer(config: Mapping | None, path: str, default: Any = REQUIRED) -> int:
    return _or_default(parse_int, config, path, default)


def get_map(config: Mapping | None, path: str) -> Mapping | None:
    value = lookup(config, path)
    if value is not None and not isinstance(value, Mapping):
        raise ConfigError(f"setting '{path}' is no map: {value}")
    return value


def _flat_or_nested(config: Mapping, key: str) -> Any:
    """Settings may be written with literal dots (``"table.name"``) or nested; literal dots win."""
    return config[key] if config.get(key) is not None else lookup(config, key)


def _setting(key: str, default: Any = REQUIRED):
    made = {} if default is REQUIRED else {"default_factory": default} if callable(default) else {"default": default}
    return field(**made, metadata={"key": key})


def _read(kind: type, config: Mapping) -> dict[str, Any]:
    """Values of a settings class. Numbers that can't be read fall back to the default, with a warning."""
    out = {}
    for f in fields(kind):
        key = f.metadata["key"]
        value = _flat_or_nested(config, key)
        if value is None:
            if f.metadata.get("required"):
                raise ConfigError(f"setting '{key}' is required")
            continue
        if f.type == "int":
            try:
                value = parse_int(value, key)
            except ConfigError as e:
                log.warning("%s; using %s", e, f.default)
                continue
        out[f.name] = str(value) if f.type == "str" else value
    return out


def _required(key: str):
    return field(metadata={"key": key, "required": True})


@dataclass(frozen=True)
class LakeConfig:
    """A changelog table as source, and the index it fills. Spark's own slots, batches and polls take the place of
    ``worker.threads``, ``batch.size`` and ``poll.timeout.ms``: these are accepted and have no effect."""

    database: str = _required("database.name")
    table: str = _required("table.name")
    index: str = _required("target.index.name")
    warehouse: str = _required("warehouse.path")
    workers: int = _setting("worker.threads", 4)
    batch_size: int = _setting("batch.size", 1000)
    poll_timeout_ms: int = _setting("poll.timeout.ms", 1000)
    scan_interval_ms: int = _setting("scan.interval.ms", 30_000)
    queue_capacity: int = _setting("queue.capacity", 10_000)
    checkpoint_timeout_minutes: int = _setting("checkpoint.timeout.minutes", 10)
    rename: Mapping[str, str] = _setting("field.mapping", dict)
    drop_prefixes: list[str] = _setting("field.drop.prefixes", list)
    sharding: Mapping[str, Any] = _setting("sharding", dict)
    s3: Mapping[str, Any] = _setting("s3", dict)

    @classmethod
    def read(cls, config: Mapping) -> LakeConfig:
        return cls(**_read(cls, config))

    @property
    def path(self) -> str:
        """Database and table; either may hold dots."""
        return f"{self.database}.{self.table}"


@dataclass(frozen=True)
class TopicConfig:
    """A topic as source. Settings for auto-commit and field registration are accepted and have no effect."""

    topic: str = _required("topic")
    index: str = _required("indexName")
    servers: str = _setting("bootstrapServers", "localhost:9092")
    group: str = _setting("groupId", "index-ingest")
    offset_reset: str = _setting("autoOffsetReset", "earliest")
    registry: str = _setting("schemaRegistryUrl", "")
    raw_batch_size: str = _setting("batchSize", "1000")

    def __post_init__(self) -> None:
        for name, said in (("topic", "a topic"), ("index", "an index name"), ("servers", "bootstrap servers")):
            if not getattr(self, name):
                raise ConfigError(f"{said} must be given ('{next(f.metadata['key'] for f in fields(self) if f.name == name)}')")

    @classmethod
    def read(cls, config: Mapping) -> TopicConfig:
        return cls(**_read(cls, config))

    @property
    def batch_size(self) -> int:
        """Read when asked for: a bad number is an error then and not before."""
        return parse_int(self.raw_batch_size, "batchSize")


# S3A settings of any s3a:// warehouse.
S3A_ALWAYS = {
    "fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
    "fs.s3a.connection.maximum": "256",
    "fs.s3a.threads.max": "128",
    "fs.s3a.block.size": "64M",
}
STATIC_KEYS = "org.apache.hadoop.fs.s3a.SimpleAWSCredentialsProvider"
DEFAULT_CHAIN = "com.amazonaws.auth.DefaultAWSCredentialsProviderChain"


def s3a_options(warehouse: str, s3: Mapping[str, Any] | None = None) -> dict[str, str]:
    """Hadoop settings for a warehouse: none unless it is s3a://; static keys where an endpoint is given, else the default chain."""
    if not warehouse.startswith("s3a://"):
        return {}
    s3 = s3 or {}
    if s3.get("endpoint") is None:
        return S3A_ALWAYS | {"fs.s3a.aws.credentials.provider": DEFAULT_CHAIN}
    missing = [k for k in ("s3-access-key", "s3-secret-key") if s3.get(k) is None]
    if missing:
        raise ConfigError(f"an S3 endpoint needs {', '.join(missing)}")
    keys = {"fs.s3a.endpoint": str(s3["endpoint"]), "fs.s3a.access.key": str(s3["s3-access-key"]), "fs.s3a.secret.key": str(s3["s3-secret-key"])}
    style = {"fs.s3a.path.style.access": "true"} if str(s3.get("path.style.access", "")).lower() == "true" else {}
    return S3A_ALWAYS | keys | style | {"fs.s3a.aws.credentials.provider": STATIC_KEYS}


def spark_options(warehouse: str, s3: Mapping[str, Any] | None = None) -> dict[str, str]:
    """The same as settings of a Spark session."""
    return {f"spark.hadoop.{k}": v for k, v in s3a_options(warehouse, s3).items()}
