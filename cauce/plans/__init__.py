"""Ready-made flows per domain, composed from the operators."""
