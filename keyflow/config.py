"""Configuration: strict YAML, exactly one sink."""

from __future__ import annotations

import re
from dataclasses import dataclass, field, fields, is_dataclass
from typing import get_args, get_type_hints

import yaml

from keyflow.operators.rules import Rule


class ConfigError(ValueError):
    pass


@dataclass
class Source:
    path: str = ""
    source_id: str = ""
    db: str = "db0"
    session_id: int | None = None
    max_bytes: int = 0
    start: str = ""


@dataclass
class TopicSink:
    brokers: list[str] = field(default_factory=list)
    topic: str = ""
    include_heartbeats: bool = False
    compression: str = "none"
    client_id: str = "keyflow"
    batch_bytes: int = 0
    partitions: int = 0


@dataclass
class FileSink:
    path: str = ""
    include_heartbeats: bool = False


@dataclass
class Sinks:
    kafka: TopicSink | None = None
    file: FileSink | None = None


@dataclass
class Pipeline:
    driver: str = ""
    dsn: str = ""
    fenodes: list[str] = field(default_factory=list)
    user: str = "root"
    password: str = ""
    sequence_column: str = ""
    max_batch_rows: int = 500
    flush_every: str = "1s"
    rules: list[Rule] = field(default_factory=list)


@dataclass
class Config:
    source: Source = field(default_factory=Source)
    sink: Sinks = field(default_factory=Sinks)
    pipeline: Pipeline | None = None
    checkpoint: str = ""
    snapshot: str = ""
    include_ttl: bool = True
    heartbeat: str = "0s"
    stall: str = "0s"
    metrics: str = ""


def seconds(text: str | int) -> float:
    """``250ms``, ``5s``, ``1m30s``, ``2h``; a bare number counts milliseconds."""
    if isinstance(text, int) or str(text).isdigit():
        return int(text) / 1000
    parts = re.findall(r"(\d+(?:\.\d+)?)(ms|s|m|h)", str(text))
    if not parts or "".join(a + b for a, b in parts) != str(text):
        raise ConfigError(f"bad duration {text!r}")
    return sum(float(n) * {"ms": 0.001, "s": 1, "m": 60, "h": 3600}[unit] for n, unit in parts)


def _build(kind, values, where: str):
    if values is None:
        return kind()
    if not isinstance(values, dict):
        raise ConfigError(f"{where}: a mapping is expected")
    hints, known = get_type_hints(kind), {f.name for f in fields(kind)}
    if unknown := sorted(set(values) - known):
        raise ConfigError(f"{where}: unknown keys {', '.join(unknown)}")
    out = {}
    for name, value in values.items():
        inner = next((t for t in (hints[name], *get_args(hints[name])) if is_dataclass(t)), None)
        if inner and isinstance(value, list):
            value = [_build(inner, v, f"{where}.{name}") for v in value]
        elif inner:
            value = _build(inner, value, f"{where}.{name}")
        out[name] = value
    try:
        return kind(**out)
    except (TypeError, ValueError) as e:
        raise ConfigError(f"{where}: {e}") from e


def parse(text: str) -> Config:
    try:
        config = _build(Config, yaml.safe_load(text) or {}, "config")
    except yaml.YAMLError as e:
        raise ConfigError(str(e)) from e
    if not config.source.path or not config.source.source_id:
        raise ConfigError("source.path and source.source_id are required")
    chosen = [x for x in (config.sink.kafka, config.sink.file, config.pipeline) if x is not None]
    if len(chosen) != 1:
        raise ConfigError("exactly one of sink.kafka, sink.file and pipeline is required")
    if (k := config.sink.kafka) and not (k.brokers and k.topic):
        raise ConfigError("sink.kafka needs brokers and topic")
    if (f := config.sink.file) and not f.path:
        raise ConfigError("sink.file needs a path")
    if p := config.pipeline:
        if not p.driver or not p.rules:
            raise ConfigError("pipeline needs driver and rules")
        if p.driver == "doris" and not p.fenodes or p.driver != "doris" and not p.dsn:
            raise ConfigError("pipeline needs fenodes (doris) or dsn")
        seconds(p.flush_every)
    if config.source.start and not re.fullmatch(r"earliest|latest|\d+:\d+", config.source.start):
        raise ConfigError("source.start is earliest, latest or FILE:BYTE")
    for text in (config.heartbeat, config.stall):
        seconds(text)
    if config.metrics and not re.fullmatch(r".*:\d+", config.metrics):
        raise ConfigError("metrics is host:port")
    config.checkpoint = config.checkpoint or config.source.path.rstrip("/") + "-checkpoint"
    return config


def load(path: str) -> Config:
    with open(path, encoding="utf-8") as f:
        return parse(f.read())
