"""Column-level expressions: everything here returns a Spark Column and runs inside whole-stage codegen."""
