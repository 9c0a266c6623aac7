"""Column expressions shared by the operators (all built-in, all inside codegen)."""
