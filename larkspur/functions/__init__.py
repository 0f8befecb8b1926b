"""See the package README for what lives here."""
