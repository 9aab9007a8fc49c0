"""Which part of a table an instance reads: everything, or the partition that its service name ends in."""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any, Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import ConfigError, get_integer, get_string


class Sharding(Protocol):
    def validate(self, name: str, partition_keys: list[str]) -> None:
        """Raises ValueError for a table that can't be read this way."""

    def apply(self, table: DataFrame, service: str) -> DataFrame:
        """The part of the table that a service reads."""

    def describe(self) -> str: ...


#: Fixed value.
EVERYTHING = "No sharding - processing all data"


class NoSharding:
    def validate(self, name: str, partition_keys: list[str]) -> None:
        return None

    def apply(self, table: DataFrame, service: str) -> DataFrame:
        return table

    def describe(self) -> str:
        return EVERYTHING


def shard_id(service: str, shards: int) -> int:
    """The number that a service name ends in, after its last ``_`` or ``-``; separators at the end don't count."""
    segments = re.split("[_-]", service.rstrip("_-") if service.strip("_-") else "")
    hint = f"a service name must end in its shard, 0 to {shards - 1}, like 'search-photos-0'"
    if segments == [""]:
        raise ValueError(f"'{service}' holds no shard: {hint}")
    last = segments[-1]
    if not re.fullmatch(r"\+?[0-9]+", last):
        raise ValueError(f"'{service}' ends in '{last}', which is no number: {hint}")
    if not int(last) < shards:
        raise ValueError(f"'{service}' names shard {int(last)}, outside [0, {shards}): check max_shards")
    return int(last)


@dataclass(frozen=True)
class ModuloSharding:
    """One partition for each instance. The filter is on a partition column, so other partitions' files are never listed or opened."""

    max_shards: int
    partition_field: str

    def __post_init__(self) -> None:
        if self.max_shards <= 0:
            raise ValueError(f"max_shards must be positive, not {self.max_shards}")
        if not (self.partition_field or "").strip():
            raise ValueError("modulo sharding needs a partition_field")
        object.__setattr__(self, "partition_field", self.partition_field.strip())

    def validate(self, name: str, partition_keys: list[str]) -> None:
        if not partition_keys:
            raise ValueError(f"table '{name}' isn't partitioned; partition it by {self.partition_field} or set sharding.strategy to 'none'")
        if self.partition_field not in partition_keys:
            raise ValueError(f"table '{name}' is partitioned by {partition_keys}, not by {self.partition_field}")

    def apply(self, table: DataFrame, service: str) -> DataFrame:
        return table.where(F.col(self.partition_field) == F.lit(shard_id(service, self.max_shards)))

    def describe(self) -> str:
        return f"one of {self.max_shards} partitions of {self.partition_field}"


class GeoSharding:
    """Named in the configuration, and not supported."""

    def validate(self, name: str, partition_keys: list[str]) -> None:
        raise NotImplementedError("geo sharding isn't supported")

    def apply(self, table: DataFrame, service: str) -> DataFrame:
        raise NotImplementedError("geo sharding isn't supported")

    def describe(self) -> str:
        return "Geo sharding (not supported)"


def sharding_of(config: Mapping[str, Any] | None) -> Sharding:
    """The strategy a configuration names; none where there is no configuration."""
    if not config:
        return NoSharding()
    name = get_string(config, "strategy")
    made = {
        "none": NoSharding,
        "geo": GeoSharding,
        "modulo": lambda: ModuloSharding(get_integer(config, "modulo.max_shards"), get_string(config, "modulo.partition_field")),
    }
    if name.lower() not in made:
        raise ConfigError(f"unknown sharding strategy '{name}'; there are {', '.join(made)}")
    return made[name.lower()]()


def shard_of(key: Column, shards: int, wrap_negative: bool = True) -> Column:
    """The shard a writer gives to a key. With ``wrap_negative`` negative keys get a shard too; the plain remainder is negative, and no instance reads it."""
    return F.pmod(key, F.lit(shards)) if wrap_negative else key % F.lit(shards)
