"""Column -> Column helpers; every one of them stays inside the JVM."""
