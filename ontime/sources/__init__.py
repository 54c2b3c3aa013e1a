"""Readers and writers: raw CSV, clean Parquet, requests, reports and model artefacts."""
