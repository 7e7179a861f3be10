"""Scalar column expressions (JVM-side, whole-stage-codegen friendly)."""

from trackstream.functions.expressions import *  # noqa: F401,F403
