"""Keyed state over unbounded inputs."""
