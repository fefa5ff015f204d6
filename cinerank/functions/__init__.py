"""Column-expression helpers (all JVM-side, inside whole-stage codegen)."""
