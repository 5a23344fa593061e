"""Column expressions (JVM-side, codegen-friendly) used across the engine."""
