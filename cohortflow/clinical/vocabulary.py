"""Fixed values of the clinical domain: categories that results depend on."""

ONCOLOGY = ["Non-Small Cell Lung Cancer", "Breast Cancer", "Colorectal Cancer", "Hepatocellular Carcinoma"]
ACTIVE_ARMS = ["Drug", "Drug + Standard of Care"]
