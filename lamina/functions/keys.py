"""Content keys, configuration digests and model names."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def content_hash(content: Column) -> Column:
    """SHA-256 in hexadecimal; null stays null."""
    return F.sha2(content, 256)


def tile_key(content: Column, prompt: Column, model: Column) -> Column:
    """SHA-256 over content, prompt and model, separated by zero bytes."""
    zero = F.unhex(F.lit("00"))
    return F.sha2(F.concat(content.cast("binary"), zero, F.encode(prompt, "UTF-8"), zero, F.encode(model, "UTF-8")), 256)


def config_digest(config: Mapping, without: tuple[str, ...] = ()) -> str:
    """Digest of a configuration's JSON with sorted keys."""
    kept = {k: v for k, v in config.items() if k not in without}
    return hashlib.sha256(json.dumps(kept, ensure_ascii=False, sort_keys=True).encode("utf-8")).hexdigest()


def model_signature(name: Column, max_pixels: Column, max_tokens: Column) -> Column:
    """A model's name with every limit that changes its results."""
    return F.format_string("%s;%dpx;%dtok", name, max_pixels.cast("long"), max_tokens.cast("long"))


def split_model(signature: Column, split: Column, version: str) -> Column:
    """The signature names the split version only where the request is split."""
    return F.when(split, F.concat(signature, F.lit(";"), F.lit(version))).otherwise(signature)


def cache_shard(key: Column) -> Column:
    """Folder of a cached file: the first two digits of its key."""
    return F.concat(F.substring(key, 1, 2), F.lit("/"), key, F.lit(".json"))


def retry_delay(attempt: Column) -> Column:
    """Seconds before the n-th retry, (n + 7) squared; attempts start at 1."""
    return F.when(attempt >= 1, F.pow(attempt + F.lit(7), F.lit(2)).cast("long")).otherwise(F.raise_error(F.lit("attempts start at 1")).cast("long"))


def rotate_user(users: Column, initial: Column, retry: Column) -> Column:
    """The active one of a list of users after so many retries."""
    return F.element_at(users, (F.pmod(initial + retry, F.size(users)) + 1).cast("int"))


def rotated(users: Column, start: Column) -> Column:
    """The distinct users in first-occurrence order, starting from the chosen one."""
    kept = F.array_distinct(users)
    at = F.greatest(F.array_position(kept, start), F.lit(1)).cast("int")
    return F.concat(F.slice(kept, at, F.size(kept)), F.slice(kept, F.lit(1), at - 1))


def credentials(text: Column) -> Column:
    """(url, api_key, users) of a document of credentials, a value a line; what is missing is null or empty."""
    one = lambda pattern: F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))
    users = F.array_distinct(F.regexp_extract_all(text, F.lit(r"(?im)^\s*user(?:[_ ]?id)?\s*[:=：]\s*([A-Za-z0-9_-]+)"), F.lit(1)))
    return F.struct(one(r"(https?://[^\s\"']+)").alias("url"), one(r"(?i)api[_-]?key\s*[:=：]\s*[\"']?([A-Za-z0-9_-]+)").alias("api_key"), users.alias("users"))
