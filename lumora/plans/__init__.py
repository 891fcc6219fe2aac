"""Plan building blocks shared by the operators."""
