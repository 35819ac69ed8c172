"""Column expressions shared by rules, standardisers and reports. All run in the JVM."""
