"""Object stores: S3 settings from the environment, and file systems for Python code that Spark runs outside the JVM."""

from __future__ import annotations

import os
import re
from collections.abc import Mapping
from urllib.parse import urlsplit

import pyarrow.fs as pafs
from pyspark.sql import SparkSession

_AUTH = "org.apache.hadoop.fs.s3a."


def _endpoint(env: Mapping[str, str]) -> tuple[str, bool]:
    """Host and port, and whether connections are encrypted; without an endpoint, those of the public service."""
    url = env.get("S3_ENDPOINT_URL") or ""
    parts = urlsplit(url if "//" in url else f"//{url}")
    return parts.netloc, (parts.scheme or ("http" if url else "https")) == "https"


def s3_settings(env: Mapping[str, str] | None = None) -> dict[str, str]:
    """Hadoop's S3A settings from S3_REGION, S3_ACCESS_KEY_ID, S3_SECRET_ACCESS_KEY, S3_SESSION_TOKEN, S3_ENDPOINT_URL and S3_URL_STYLE.

    Without keys, Hadoop's own chain of credentials stays. The style is `path` unless it is named.
    """
    env = os.environ if env is None else env
    host, encrypted = _endpoint(env)
    out = {
        "fs.s3a.endpoint.region": env.get("S3_REGION") or "us-east-1", "fs.s3a.connection.ssl.enabled": str(encrypted).lower(),
        "fs.s3a.path.style.access": str((env.get("S3_URL_STYLE") or "path") == "path").lower(),
    }
    if host:
        out["fs.s3a.endpoint"] = host
    if env.get("S3_ACCESS_KEY_ID"):
        out |= {"fs.s3a.access.key": env["S3_ACCESS_KEY_ID"], "fs.s3a.secret.key": env.get("S3_SECRET_ACCESS_KEY") or ""}
        token = env.get("S3_SESSION_TOKEN")
        out["fs.s3a.aws.credentials.provider"] = _AUTH + ("TemporaryAWSCredentialsProvider" if token else "SimpleAWSCredentialsProvider")
        if token:
            out["fs.s3a.session.token"] = token
    return out


def configure_s3(spark: SparkSession, env: Mapping[str, str] | None = None) -> SparkSession:
    """The settings for all file systems that the session opens from now on, and `s3://` read by S3A."""
    conf = spark._jsc.hadoopConfiguration()
    for k, v in (s3_settings(env) | {"fs.s3.impl": f"{_AUTH}S3AFileSystem"}).items():
        conf.set(k, v)
    return spark


def filesystem(uri: str, env: Mapping[str, str] | None = None) -> tuple[pafs.FileSystem, str]:
    """The file system of a URI and the path in it, for Python sources and tasks."""
    env = os.environ if env is None else env
    parts = urlsplit(uri)
    if parts.scheme in ("", "file"):
        return pafs.LocalFileSystem(), re.sub("^file:(//)?", "", uri)
    if parts.scheme in ("s3", "s3a", "s3n"):
        host, encrypted = _endpoint(env)
        keys = {"access_key": env["S3_ACCESS_KEY_ID"], "secret_key": env.get("S3_SECRET_ACCESS_KEY"), "session_token": env.get("S3_SESSION_TOKEN")} if env.get("S3_ACCESS_KEY_ID") else {}
        virtual = (env.get("S3_URL_STYLE") or "path") != "path"
        return pafs.S3FileSystem(region=env.get("S3_REGION") or "us-east-1", scheme="https" if encrypted else "http", endpoint_override=host or None, force_virtual_addressing=virtual and bool(host), **keys), f"{parts.netloc}{parts.path}"
    return pafs.FileSystem.from_uri(uri)
