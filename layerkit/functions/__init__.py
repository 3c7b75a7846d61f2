"""Column-expression helpers (stay inside whole-stage codegen; no Python UDFs)."""
