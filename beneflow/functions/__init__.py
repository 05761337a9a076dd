"""Column factories: plain expressions that stay inside whole-stage codegen."""
